"""Sharded source, atomic and keyed sinks, the live join and the supervisor."""

import glob
import json
import os
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.plans import catalog  # noqa: F401  (registers; live_keys cannot come first)
from postflow.plans.live_keys import BATCHES, _run_join
from postflow.schemas import POSTS_STREAM
from postflow.session import DRAIN_SETTINGS, drain_settings, use_state_on_disk
from postflow.sources import sharded as S
from postflow.streaming.keyed import KeyedTable, commit_batch
from postflow.streaming.live import join_live, start_counts, timed_rows
from postflow.streaming.pipeline import RECORD_SCHEMA, start_append
from postflow.streaming.supervisor import Supervisor


def records(spark, lo, hi):
    return spark.range(lo, hi, 1, 3).select(F.col("id").cast("string").alias("partitionKey"), F.encode(F.concat(F.lit("r"), "id"), "UTF-8").alias("data"),
                                            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("arrivalTimestamp"))


def drain(spark, root, table="out", checkpoint="ck", **options):
    src = S.read_record_stream(spark, root, "eu", "s", **options)
    start_append(src, f"{root}/{table}", f"{root}/{checkpoint}", sink="atomic").awaitTermination()
    return spark.read.parquet(f"{root}/{table}")


# ------------------------------------------------------------------ sharded source
def test_sharded_restart_and_new_shards(spark, workdir):
    S.put_records(records(spark, 0, 5000), workdir, "eu", "s", shards=2)
    first = drain(spark, workdir, maxRecordsPerPartition=700)
    assert first.count() == 5000
    tail = S.put_records(records(spark, 5000, 9000), workdir, "eu", "s", shards=4)          # two shards more
    assert set(tail) == {f"shard-{i}" for i in range(4)} and sum(tail.values()) == 9000
    for _ in range(2):                                                                         # the second run finds nothing new
        out = drain(spark, workdir)
    assert out.count() == 9000 and out.select("data").distinct().count() == 9000
    per = out.groupBy("shardId").agg(F.count("*").alias("n"), F.countDistinct("sequenceNumber").alias("d"), F.max("sequenceNumber").alias("m")).collect()
    assert all(r.n == r.d == r.m + 1 for r in per)
    offsets = open(f"{workdir}/ck/offsets/0").read()
    assert json.loads(offsets.splitlines()[-1]) and "accessKey" not in offsets


def test_sharded_batch_ranges(spark, workdir):
    S.put_records(records(spark, 0, 4100), workdir, "eu", "s", shards=1)
    df = S.read_records(spark, workdir, "eu", "s", maxRecordsPerPartition=1000)
    assert df.rdd.getNumPartitions() == 5 and df.count() == 4100
    row = df.where("sequenceNumber = 2500").collect()
    assert len(row) == 1 and row[0].streamName == "s" and row[0].arrivalTimestamp == datetime(2024, 1, 1)
    assert S.read_records(spark, workdir, "eu", "nothing").count() == 0
    with pytest.raises(Exception, match="streamName"):
        S.register(spark)
        spark.read.format(S.FORMAT).options(endpoint=workdir, region="eu").load().count()


def test_put_holds_no_segment(spark, workdir, monkeypatch):
    """Records go to the segment file as they come: a shard holds less than BATCH_ROWS of them, whatever the segment's size."""
    import pyarrow as pa
    from pyarrow import fs

    monkeypatch.setattr(S, "SEGMENT_ROWS", 5 * S.BATCH_ROWS)
    rows = pa.RecordBatch.from_pydict({"partitionKey": [str(i) for i in range(777)], "data": [b"x"] * 777, "arrivalTimestamp": [datetime(2024, 1, 1)] * 777},
                                      schema=S.RECORD)
    file, left, n = S._SegmentFile(fs.LocalFileSystem(), workdir), 0, 0
    while not file.full:
        left = file.add(rows).num_rows
        n += 777 - left
        assert file.n_held == sum(b.num_rows for b in file.held) < S.BATCH_ROWS
    name, count = file.close()
    assert count == n == S.SEGMENT_ROWS and left == 777 - n % 777
    with pa.OSFile(f"{workdir}/{name}") as f:
        reader = pa.ipc.open_file(f)
        assert [reader.get_batch(i).num_rows for i in range(reader.num_record_batches)] == [S.BATCH_ROWS] * 5


def test_sharded_starting_positions(spark, workdir):
    S.put_records(records(spark, 0, 100), workdir, "eu", "s", shards=1)
    assert drain(spark, workdir, "late", "c1", startingPosition="latest").count() == 0
    assert drain(spark, workdir, "some", "c2", startingPosition={"shard-0": 60}).count() == 40
    S.put_records(records(spark, 100, 130), workdir, "eu", "s", shards=1)
    assert drain(spark, workdir, "late", "c1", startingPosition="latest").count() == 30


def test_sharded_retention(spark, workdir):
    for lo in (0, 100, 200):
        S.put_records(records(spark, lo, lo + 100), workdir, "eu", "s", shards=1)
    store = S.StreamStore({"endpoint": workdir, "region": "eu", "streamName": "s"})
    assert S.trim_records(spark, workdir, "eu", "s", {"shard-0": 150}) == 4        # a put of 100 has three segments
    assert min(x.first for x in store.segments("shard-0")) > 0 and store.bounds()["shard-0"][1] == 300
    with pytest.raises(RuntimeError, match="gone"):
        list(store.read("shard-0", 0, 10))
    strict, loose = (S.RecordReader({"endpoint": workdir, "region": "eu", "streamName": "s", "failOnDataLoss": x}) for x in ("true", "false"))
    ranges = S.cut_ranges({"shard-0": 0}, {"shard-0": 300}, 1000)
    oldest = store.bounds()["shard-0"][0]
    assert strict.held(ranges)[0].start == 0 and loose.held(ranges)[0].start == oldest
    assert S.read_records(spark, workdir, "eu", "s").count() == 300 - oldest


# ------------------------------------------------------------------ sinks
def test_commit_batch_is_whole_and_once(spark, workdir):
    rows = spark.range(50)
    assert commit_batch(rows, f"{workdir}/t", "a", 0) and not commit_batch(rows, f"{workdir}/t", "a", 0)
    with pytest.raises(Exception, match="planted"):
        commit_batch(rows.withColumn("id", F.when(F.col("id") == 49, F.raise_error(F.lit("planted")).cast("long")).otherwise(F.col("id"))), f"{workdir}/t", "a", 1)
    assert spark.read.parquet(f"{workdir}/t").count() == 50                   # nothing of the dead batch is seen
    assert commit_batch(rows, f"{workdir}/t", "a", 1) and spark.read.parquet(f"{workdir}/t").count() == 100


def test_keyed_table(spark, workdir):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("j", T.LongType()), T.StructField("n", T.LongType())])
    t = KeyedTable(spark, f"{workdir}/t", schema, ["k", "j"], buckets=4)
    assert t.read().count() == 0
    assert t.upsert(spark.createDataFrame([("a", 1, 1), (None, None, 1), ("b", 2, 1)], schema), "r", 0)
    before = t.read()
    assert t.upsert(spark.createDataFrame([("a", 1, 5), (None, None, 6), ("c", 3, 1)], schema), "r", 1)
    want = {("a", 1): 5, (None, None): 6, ("b", 2): 1, ("c", 3): 1}
    assert {(r.k, r.j): r.n for r in t.read().collect()} == want
    assert not t.upsert(spark.createDataFrame([("a", 1, 99)], schema), "r", 1)      # a repeated batch
    assert {(r.k, r.j): r.n for r in before.collect()} == {("a", 1): 1, (None, None): 1, ("b", 2): 1}     # an old reader keeps its version
    assert t.upsert(spark.createDataFrame([("a", 1, 7)], schema), "other", 0) and {(r.k, r.j): r.n for r in t.read().collect()} == want | {("a", 1): 7}
    assert t.vacuum() >= 0 and {(r.k, r.j): r.n for r in t.read().collect()} == want | {("a", 1): 7}


# ------------------------------------------------------------------ live join and counts
def post(i, text=True):
    return json.dumps({"index": i, "unique_id": f"u{i}", "category": f"c{i % 2}"}) if text else None


def land(spark, path, rows):
    """rows: (key, payload or None, minutes after day 0)"""
    at = datetime(2024, 1, 1)
    data = [("s", str(k), None if p is None else p.encode(), at + timedelta(minutes=m)) for k, p, m in rows]
    spark.createDataFrame(data, RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def joined(spark, workdir, dedup=True):
    posts, geo = (spark.readStream.schema(RECORD_SCHEMA).parquet(f"{workdir}/{x}") for x in ("posts", "geo"))
    q = start_append(join_live(posts, geo, "10 minutes", "30 minutes", dedup), f"{workdir}/joined", f"{workdir}/cj", sink="atomic")
    q.awaitTermination()
    return q


def test_live_join_keeps_bounded_state(spark, workdir):
    geo_row = lambda i: json.dumps({"ind": i, "country": f"land{i}", "latitude": 1.0, "longitude": 2.0})
    land(spark, f"{workdir}/posts", [(1, post(1), 0), (1, post(1), 1), (2, post(2), 0), (3, post(3), 0), (9, None, 0)])
    land(spark, f"{workdir}/geo", [(1, geo_row(1), 5), (3, geo_row(3), 100)])          # 3: too long after its post
    joined(spark, workdir)
    seen = spark.read.parquet(f"{workdir}/joined")
    assert [(r.ind, r.country) for r in seen.collect()] == [(1, "land1")]                # repeated record joined once, 2 and 3 still wait
    for x in ("posts", "geo"):
        land(spark, f"{workdir}/{x}", [(0, None, 600)])                                  # heartbeats
    q = joined(spark, workdir)
    got = sorted((r.ind, r.country) for r in spark.read.parquet(f"{workdir}/joined").collect())
    assert got == [(1, "land1"), (2, None), (3, None)]
    state = q.recentProgress[-1].stateOperators if hasattr(q.recentProgress[-1], "stateOperators") else q.recentProgress[-1]["stateOperators"]
    rows = [s.numRowsTotal if hasattr(s, "numRowsTotal") else s["numRowsTotal"] for s in state]
    assert sum(rows) == 0                                                                # the watermark emptied every state


def test_live_join_state_is_on_disk(spark, workdir):
    """Not one of the stateful operators keeps its rows in the executors' heaps, and a join has one store a partition."""
    for x in ("posts", "geo"):
        land(spark, f"{workdir}/{x}", [(1, post(1), 0)])
    q = joined(spark, workdir)
    last = json.loads(q.recentProgress[-1].json if hasattr(q.recentProgress[-1], "json") else json.dumps(q.recentProgress[-1]))
    assert len(last["stateOperators"]) == 3
    assert all(any(k.startswith("rocksdb") for k in s["customMetrics"]) for s in last["stateOperators"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [s["numStateStoreInstances"] for s in last["stateOperators"]] == [parts] * 3


def newest_snapshots(root):
    """Of every state store below ``root``: the SST files of its newest snapshot."""
    stores = {}
    for f in glob.glob(f"{root}/state/*/*/*.zip"):
        stores.setdefault(os.path.dirname(f), []).append(int(os.path.basename(f).removesuffix(".zip")))
    out = {}
    for store, versions in stores.items():
        with zipfile.ZipFile(f"{store}/{max(versions)}.zip") as z:
            out[store] = json.loads(z.read("metadata").decode().split("\n", 1)[1])["sstFiles"]
    return out


def test_drained_join_keeps_little_on_disk(spark, workdir):
    """Snapshots in place of change logs, none of the rows that have left the state, and no shuffle beyond its batch."""
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for minute, live in ((0, True), (600, False)):                                       # rows, then heartbeats
        for x in ("posts", "geo"):
            land(spark, f"{workdir}/{x}", [(i, post(i) if live else None, minute) for i in range(20)])
        before = shuffles.size()
        joined(spark, workdir)
        assert shuffles.size() <= before
        held = newest_snapshots(f"{workdir}/cj")
        assert len(held) == 3 * parts and any(held.values()) == live
        assert not glob.glob(f"{workdir}/cj/state/*/*/*.changelog")


def test_drain_settings_last_for_the_start(spark):
    """They hold inside, for drained queries only, not against the caller's own, and the session is left as it was."""
    use_state_on_disk(spark)
    retain, logs = "spark.sql.streaming.minBatchesToRetain", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = dict(spark.conf.getAll)
    with drain_settings(spark, "10 seconds"):
        assert dict(spark.conf.getAll) == before
    with drain_settings(spark, "availableNow"):
        assert {k: spark.conf.get(k) for k in DRAIN_SETTINGS} == DRAIN_SETTINGS
    assert dict(spark.conf.getAll) == before and before[logs] == "true"
    spark.conf.set(retain, "7")
    try:
        with drain_settings(spark, "availableNow"):
            assert (spark.conf.get(retain), spark.conf.get(logs)) == ("7", "false")
        assert spark.conf.get(retain) == "7"
    finally:
        spark.conf.unset(retain)


def test_live_join_in_batches(spark, workdir):
    """What waits is joined in ``BATCHES`` batches: pairs and copies that come in different ones count as in one."""
    geo_row = lambda i: json.dumps({"ind": i, "country": f"land{i}", "latitude": 1.0, "longitude": 2.0})
    for i in range(BATCHES):                                                             # posts from 0 up, their places from the last down
        land(spark, f"{workdir}/posts", [(i, post(i), 0), (0, post(0), 0), (100 + i, post(100 + i), 0)])
        land(spark, f"{workdir}/geo", [(BATCHES - 1 - i, geo_row(BATCHES - 1 - i), 0), (1, geo_row(1), 0)])
    _run_join(spark, workdir, BATCHES)
    assert len(glob.glob(f"{workdir}/joined/run=*/batch=*")) >= BATCHES
    for x in ("posts", "geo"):
        land(spark, f"{workdir}/{x}", [(0, None, 1440)])
    _run_join(spark, workdir, 1)
    got = sorted((r.ind, r.country) for r in spark.read.parquet(f"{workdir}/joined").collect())
    assert got == [(i, f"land{i}") for i in range(BATCHES)] + [(100 + i, None) for i in range(BATCHES)]


def test_live_counts_follow_batches(spark, workdir):
    table = KeyedTable(spark, f"{workdir}/counts", T.StructType([T.StructField("category", T.StringType()), T.StructField("n", T.LongType())]), ["category"])
    want = {}
    for i in range(3):
        land(spark, f"{workdir}/posts", [(j, post(j), i) for j in range(5 + i)])
        rows = timed_rows(spark.readStream.schema(RECORD_SCHEMA).parquet(f"{workdir}/posts"), "posts", dedup=False)
        start_counts(rows.select("category"), ["category"], f"{workdir}/counts", f"{workdir}/cc", "n").awaitTermination()
        for j in range(5 + i):
            want[f"c{j % 2}"] = want.get(f"c{j % 2}", 0) + 1
        assert {r.category: r.n for r in table.read().collect()} == want
    assert "index" in POSTS_STREAM.fieldNames()


# ------------------------------------------------------------------ supervisor
def test_supervisor_restarts_one_feed_and_gives_up_another(spark, workdir):
    for f in ("a", "b", "c"):
        land(spark, f"{workdir}/{f}", [(i, post(i), 0) for i in range(4)])
    tries = {"b": 0, "c": 0}

    def start(name, failures):
        def go():
            src = spark.readStream.schema(RECORD_SCHEMA).parquet(f"{workdir}/{name}")
            if tries.get(name, 0) < failures:
                tries[name] += 1
                src = src.withColumn("streamName", F.raise_error(F.lit("planted")).cast("string"))
            return start_append(src, f"{workdir}/out-{name}", f"{workdir}/ck-{name}", sink="atomic")
        return go

    s = Supervisor(spark, {"a": start("a", 0), "b": start("b", 2), "c": start("c", 99)}, max_restarts=2, first_pause=0.05)
    assert s.run(timeout=120) == {"a": "done", "b": "done", "c": "failed"}
    assert (s.feeds["a"].restarts, s.feeds["b"].restarts, s.feeds["c"].restarts) == (0, 2, 2) and "planted" in s.feeds["c"].errors[0]
    assert [spark.read.parquet(f"{workdir}/out-{f}").count() for f in ("a", "b")] == [4, 4]
    assert [s.pause(n) for n in (1, 2, 3)] == [0.05, 0.1, 0.2] and Supervisor(spark, {}).pause(30) == 60.0
    assert Supervisor(spark, {}).run() == {}


def test_supervisor_stops_running_feeds(spark, workdir):
    land(spark, f"{workdir}/a", [(1, post(1), 0)])
    src = spark.readStream.schema(RECORD_SCHEMA).parquet(f"{workdir}/a")
    s = Supervisor(spark, {"a": lambda: start_append(src, f"{workdir}/out", f"{workdir}/ck", trigger="1 second", sink="atomic")})
    assert s.run(timeout=8) == {"a": "running"}
    s.stop()
    assert not s.active() and spark.read.parquet(f"{workdir}/out").count() == 1
