"""Wire formats (S8, S9, T1, X14) and streaming runs."""

import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from postflow.functions.envelope import (
    decode_json, encode_rest, encode_stream, rest_schema, stream_schema,
)
from postflow.schemas import GEO_STREAM
from postflow.session import SESSION_DEFAULTS
from postflow.sources.files import read_stream
from postflow.streaming.pipeline import (
    RECORD_SCHEMA, clean_records, decode_records, land_records, preview, read_appended, start_feed, run_feeds,
    start_append, to_records,
)

GEO_ROWS = [(1, datetime(2019, 3, 4, 5, 6, 7), 1.5, -2.25, "X"), (2, None, None, 3.0, None)]


def geo_df(spark):
    return spark.createDataFrame(GEO_ROWS, "ind int, timestamp timestamp, latitude double, "
                                           "longitude double, country string")


def test_encode_rest_matches_python_json(spark):
    df = spark.createDataFrame([(1, "a/b", None)], "index bigint, title string, image_src string")
    text = df.select(encode_rest(df).alias("p")).collect()[0].p
    expected = json.dumps({"records": [{"value": {"index": 1, "title": "a/b", "image_src": None}}]},
                          separators=(",", ":"))
    assert text == expected


def test_encode_stream_iso_timestamps_and_key(spark):
    df = geo_df(spark)
    out = [json.loads(r.p) for r in df.select(encode_stream(df, "geo-stream").alias("p")).collect()]
    assert out[0] == {"StreamName": "geo-stream", "PartitionKey": "1",
                      "Data": {"ind": 1, "timestamp": "2019-03-04T05:06:07", "latitude": 1.5,
                               "longitude": -2.25, "country": "X"}}
    assert out[1]["Data"]["timestamp"] is None


def test_stream_roundtrip_identity(spark):
    df = geo_df(spark)
    env = df.select(encode_stream(df, "g").alias("body"))
    back = decode_json(env, stream_schema(GEO_STREAM), "body").select("Data.*") \
        .select("ind", "timestamp", "latitude", "longitude", "country")
    assert [tuple(r) for r in back.orderBy("ind").collect()] == [
        (1, datetime(2019, 3, 4, 5, 6, 7), 1.5, -2.25, "X"), (2, None, None, 3.0, None)]


def test_rest_roundtrip(spark):
    df = spark.createDataFrame([(3, "t")], "index bigint, title string")
    env = df.select(encode_rest(df).alias("body"))
    schema = rest_schema(df.schema)
    back = decode_json(env, schema, "body").select(F.col("records")[0]["value"].alias("v")).select("v.*")
    assert [tuple(r) for r in back.collect()] == [(3, "t")]


def test_permissive_decode(spark):
    payloads = ['{"index": 1, "downloaded": 1}', "not json", '{"index": "1", "title": "x"}']
    df = spark.createDataFrame([(p.encode(),) for p in payloads], "data binary")
    rows = decode_records(df, "posts").collect()
    assert rows[0]["index"] == 1 and rows[0].downloaded == "1"   # number read into a text field (K10)
    assert all(v is None for v in rows[1])                         # broken document: all NULL
    assert rows[2]["index"] is None and rows[2].title == "x"       # bad field alone is NULL (K9)


def test_to_records_keys_by_first_column(spark):
    recs = to_records(geo_df(spark), "geo-stream").collect()
    assert [r.partitionKey for r in recs] == ["1", "2"]
    assert json.loads(bytes(recs[0].data).decode())["country"] == "X"


def _posts_rows(spark, n=5, start=0):
    rows = [(i, f"u{i}", f"T{i}", "d", "p", f"{i}k", "a,b", "image", "s", 1, "Local save in /x", "c")
            for i in range(start, start + n)]
    return spark.createDataFrame(rows, "index int, unique_id string, title string, description string, "
                                       "poster_name string, follower_count string, tag_list string, "
                                       "is_image_or_video string, image_src string, downloaded int, "
                                       "save_location string, category string")


def _run(spark, landing, table, ckpt):
    src = read_stream(spark, landing, RECORD_SCHEMA)
    start_append(clean_records(src, "posts"), table, ckpt).awaitTermination()
    return read_appended(spark, table)


def test_stream_restart_and_replay(spark, workdir):
    landing, table = f"{workdir}/landing", f"{workdir}/table"
    land_records(_posts_rows(spark), landing, "posts-stream")
    assert _run(spark, landing, table, f"{workdir}/ck1").count() == 5
    # restart on the same checkpoint: nothing new, nothing repeated
    assert _run(spark, landing, table, f"{workdir}/ck1").count() == 5
    # new rows arrive: the same checkpoint picks up only them
    land_records(_posts_rows(spark, 3, start=100), landing, "posts-stream")
    out = _run(spark, landing, table, f"{workdir}/ck1")
    assert out.count() == 8
    # replay from the start under a new checkpoint appends everything again
    assert _run(spark, landing, table, f"{workdir}/ck2").count() == 16
    got = out.where("ind = 100").collect()[0]
    assert got.follower_count == 100000 and got.save_location == "/x" and got.downloaded is True


def test_stream_latest_start_skips_old_files(spark, workdir):
    landing = f"{workdir}/landing"
    land_records(_posts_rows(spark, 4), landing, "posts-stream")
    src = read_stream(spark, landing, RECORD_SCHEMA, starting="latest", checkpoint=f"{workdir}/ck")
    q = preview(clean_records(src, "posts"), "latest_preview")
    q.processAllAvailable()
    assert spark.table("latest_preview").count() == 0
    land_records(_posts_rows(spark, 2, start=50), landing, "posts-stream")
    q.processAllAvailable()
    assert sorted(r.ind for r in spark.table("latest_preview").collect()) == [50, 51]
    q.stop()


def test_latest_start_survives_a_restart(spark, workdir):
    """Rows that land while the stream is down are delivered, each once."""
    landing, table, ck = f"{workdir}/landing", f"{workdir}/table", f"{workdir}/ck"
    land_records(_posts_rows(spark, 4), landing, "posts-stream")

    def run():
        start_feed(spark, "posts", landing, table, ck, starting="latest").awaitTermination()
    run()
    land_records(_posts_rows(spark, 3, start=20), landing, "posts-stream")
    run()
    land_records(_posts_rows(spark, 2, start=50), landing, "posts-stream")
    run()
    run()
    assert sorted(r.ind for r in read_appended(spark, table).collect()) == [20, 21, 22, 50, 51]
    with pytest.raises(ValueError):
        read_stream(spark, landing, RECORD_SCHEMA, starting="latest")


def test_run_id_lives_in_the_checkpoint(spark, workdir):
    """Other spellings of a checkpoint are the same run; a recreated one is a new run."""
    from postflow.streaming.pipeline import _run_id
    ck = f"{workdir}/ck"
    a = _run_id(spark, ck)
    assert a == _run_id(spark, ck + "/") == _run_id(spark, f"file:{ck}")
    landing, table = f"{workdir}/landing", f"{workdir}/table"
    land_records(_posts_rows(spark, 4), landing, "posts-stream")
    assert _run(spark, landing, table, ck).count() == 4
    os.rename(ck, f"{workdir}/old")                       # removed and recreated at the same path
    assert _run(spark, landing, table, ck).count() == 8


def test_named_table_sink(spark, workdir):
    landing, name = f"{workdir}/landing", f"appended_{os.path.basename(workdir).replace('-', '_')}"
    land_records(_posts_rows(spark, 4), landing, "posts-stream")
    for ck in ("a", "a", "b"):                            # a restart adds nothing, a new checkpoint a copy
        start_feed(spark, "posts", landing, name, f"{workdir}/{ck}", sink="table").awaitTermination()
    assert read_appended(spark, name).count() == 8 and "run" not in read_appended(spark, name).columns
    assert spark.sql(f"SELECT count(DISTINCT run) FROM {name}").first()[0] == 2


def test_feed_from_any_source(spark, workdir):
    """A source without schema or path: the rate stream, mapped onto records."""
    rate = read_stream(spark, None, None, fmt="rate", rowsPerSecond="50")
    records = rate.selectExpr("'geo-stream' AS streamName", "CAST(value AS STRING) AS partitionKey",
                              "CAST(to_json(named_struct('ind', CAST(value AS INT), 'country', 'X')) AS BINARY) AS data",
                              "timestamp AS arrivalTimestamp")
    q = start_feed(spark, "geo", records, f"{workdir}/t", f"{workdir}/ck", trigger="1 second")
    for _ in range(60):
        time.sleep(0.5)
        if q.lastProgress and q.lastProgress["batchId"] >= 2:      # the first batch of this source is empty
            break
    q.stop()
    assert {r.country for r in read_appended(spark, f"{workdir}/t").collect()} == {"X"}


def test_rate_setting_cuts_a_replay(spark, workdir):
    landing = f"{workdir}/landing"
    for i in range(4):
        land_records(_posts_rows(spark, 1, start=i).coalesce(1), landing, "posts-stream")
    q = start_feed(spark, "posts", landing, f"{workdir}/t", f"{workdir}/ck", max_files_per_trigger=1)
    q.awaitTermination()
    assert read_appended(spark, f"{workdir}/t").count() == 4
    run, = os.listdir(f"{workdir}/t")
    assert len([b for b in os.listdir(f"{workdir}/t/{run}") if b.startswith("batch=")]) >= 4


def test_dedup_state_holds_no_payload(spark, workdir):
    landing = f"{workdir}/landing"
    land_records(_posts_rows(spark, 3), landing, "posts-stream")
    land_records(_posts_rows(spark, 3), landing, "posts-stream")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", SESSION_DEFAULTS["spark.sql.streaming.stateStore.providerClass"])
    try:
        q = start_feed(spark, "posts", landing, f"{workdir}/t", f"{workdir}/ck", dedup_delay="1 hour")
        q.awaitTermination()
        plan = q._jsq.lastProgress().toString()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert read_appended(spark, f"{workdir}/t").count() == 3 and "rocksdb" in plan.lower()


def test_run_feeds_needs_separate_checkpoints(spark, workdir):
    with pytest.raises(ValueError):
        run_feeds(spark, {"posts": ("a", "b", "c"), "geo": ("d", "e", "c")})


def test_three_feeds(spark, workdir):
    geo = geo_df(spark)
    users = spark.createDataFrame([(1, datetime(2017, 1, 1), "A", "B", 20)],
                                  "ind int, date_joined timestamp, first_name string, last_name string, age int")
    feeds = {}
    for name, df in {"posts": _posts_rows(spark, 3), "geo": geo, "users": users}.items():
        land_records(df, f"{workdir}/{name}/landing", f"{name}-stream")
        feeds[name] = (f"{workdir}/{name}/landing", f"{workdir}/{name}/table", f"{workdir}/{name}/ck")
    run_feeds(spark, feeds)
    counts = {n: read_appended(spark, t).count() for n, (_, t, _) in feeds.items()}
    assert counts == {"posts": 3, "geo": 2, "users": 1}
    g = read_appended(spark, feeds["geo"][1]).orderBy("ind").collect()
    assert g[0].coordinates == [1.5, -2.25] and g[0].timestamp == datetime(2019, 3, 4, 5, 6, 7)
    u = read_appended(spark, feeds["users"][1]).collect()[0]
    assert u.user_name == "A B" and u.age == 20


def test_quarantine_and_dedup(spark, workdir):
    from postflow.streaming.pipeline import start_feed
    landing, table, bad = f"{workdir}/landing", f"{workdir}/table", f"{workdir}/bad"
    rows = _posts_rows(spark, 3)
    land_records(rows.unionAll(rows), landing, "posts-stream")          # every record twice
    broken = spark.createDataFrame([("k1", b"not json"), ("k2", b'{"index": "7"}'), ("k3", None)],
                                   "partitionKey string, data binary") \
        .selectExpr("'posts-stream' AS streamName", "partitionKey", "data",
                    "current_timestamp() AS arrivalTimestamp")
    broken.write.mode("append").parquet(landing)
    start_feed(spark, "posts", landing, table, f"{workdir}/ck", dedup_delay="1 hour",
               quarantine_path=bad).awaitTermination()
    assert sorted(r.ind for r in read_appended(spark, table).collect()) == [0, 1, 2]
    q = read_appended(spark, bad).collect()
    assert sorted(r.partitionKey for r in q) == ["k1", "k2", "k3"]
    assert {r.partitionKey: r.payload for r in q}["k1"] == "not json"


def test_append_until_stopped(spark, workdir):
    """A processing-time trigger keeps appending new records until stopped."""
    landing, table = f"{workdir}/landing", f"{workdir}/table"
    land_records(_posts_rows(spark, 2), landing, "posts-stream")
    src = read_stream(spark, landing, RECORD_SCHEMA)
    q = start_append(clean_records(src, "posts"), table, f"{workdir}/ck", trigger="1 second")
    try:
        q.processAllAvailable()
        land_records(_posts_rows(spark, 3, start=10), landing, "posts-stream")
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert sorted(r.ind for r in read_appended(spark, table).collect()) == [0, 1, 10, 11, 12]


def test_compact_appended(spark, workdir):
    from postflow.streaming.pipeline import compact_appended
    landing, table = f"{workdir}/landing", f"{workdir}/table"
    for start in (0, 10, 20):                        # three landings -> three micro-batches
        land_records(_posts_rows(spark, 2, start=start).coalesce(1), landing, "posts-stream")
    src = read_stream(spark, landing, RECORD_SCHEMA, max_files_per_trigger=1)
    start_append(clean_records(src, "posts"), table, f"{workdir}/ck").awaitTermination()
    runs = os.listdir(table)
    assert len([d for d in os.listdir(f"{table}/{runs[0]}") if d.startswith("batch=")]) == 3
    assert compact_appended(spark, table, f"{workdir}/compact") == 1
    got = sorted(r.ind for r in spark.read.parquet(f"{workdir}/compact").collect())
    assert got == [0, 1, 10, 11, 20, 21]


def test_kafka_rows_map_to_records(spark):
    from postflow.streaming.pipeline import from_kafka
    payload = b'{"ind": 3, "latitude": 1.5, "longitude": 2.0, "timestamp": "2020-01-01T00:00:00", "country": "X"}'
    kafka = spark.createDataFrame(
        [(b"3", payload, "geo-stream", 0, 7, datetime(2024, 1, 1), 0)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
        "timestampType int")
    recs = from_kafka(kafka)
    assert recs.schema == RECORD_SCHEMA
    row = clean_records(recs, "geo").collect()[0]
    assert (row.ind, row.country, row.coordinates) == (3, "X", [1.5, 2.0])


# ------------------------------------------------------------------ first start
def test_first_start_is_kept_and_errors_are_raised(spark, workdir):
    from postflow.sources.files import first_start

    made = []

    def make():
        made.append(1)
        return spark.createDataFrame([(len(made),)], "run int")
    assert first_start(spark, f"{workdir}/ck", "run", make).first().run == 1
    assert first_start(spark, f"file:{workdir}/ck", "run", make).first().run == 1 and made == [1]
    os.makedirs(f"{workdir}/dead/_postflow/run/_temporary/0")                  # a first start that was killed while writing
    assert first_start(spark, f"{workdir}/dead", "run", make).first().run == 2
    broken = f"{workdir}/bad/_postflow/run"
    os.makedirs(broken)
    with open(f"{broken}/part-0.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):                                             # unreadable is not absent: no new run id
        first_start(spark, f"{workdir}/bad", "run", make).first()
    assert len(made) == 2
