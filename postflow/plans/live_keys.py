"""Registered keys of the sharded stream source, the live join and counts, and the supervisor."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from postflow.functions.envelope import decode_json
from postflow.operators.incremental import IncrementalFeed
from postflow.plans import questions as Q
from postflow.plans.catalog import _COUNTS_BY_COUNTRY, REGISTRY, register
from postflow.plans.oracle import POSTS_COLS, posts_ctes, with_clean, with_feeds
from postflow.session import file_count, shared_dir
from postflow.sources.files import read_stream
from postflow.sources.fixtures import posts_raw, source_rows, table
from postflow.sources.sharded import put_records, read_record_stream, read_records
from postflow.streaming.dedup import dedup_with_ttl
from postflow.streaming.live import counts_table, join_live, start_counts
from postflow.streaming.pipeline import RECORD_SCHEMA, clean_records, read_appended, start_append, start_feed, to_records
from postflow.streaming.supervisor import Supervisor

REGION = "eu-west-1"
STREAM_NAMES = {"posts": "posts-stream", "geo": "geo-stream", "users": "users-stream"}
MICROS = {f"{kind}Format": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for kind in ("timestamp", "timestampNTZ")}
BATCHES = 4                              # of a join's run, if there are as many files
DAY0 = datetime(2024, 1, 1)              # arrival of a feed's first part; each further part comes a day later

_NULLED = posts_ctes("posts_raw", "pr")
_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


# --------------------------------------------------------------------------- sharded stream
def _event_records(spark, sf):
    events = table(spark, sf, "events")
    return events, events.select(F.lit("events").alias("streamName"), F.col("user_id").cast("string").alias("partitionKey"),
                                 F.encode(F.to_json(F.struct(*events.columns), MICROS | {"ignoreNullFields": "false"}), "UTF-8").alias("data"), F.col("ts").cast("timestamp").alias("arrivalTimestamp"))


@register("stream_sharded_events", _EVENTS)
def _stream_sharded_events(spark, sf):
    """Two puts, a stream started after each on one checkpoint: every event once."""
    root = shared_dir(spark, "sharded", "events")
    events, records = _event_records(spark, sf)
    late = F.xxhash64("data") % 2 == 0
    for part in (records.where(~late), records.where(late)):
        put_records(part, root, REGION, "events", shards=8)
        src = read_record_stream(spark, root, REGION, "events")
        rows = src.select(F.from_json(F.col("data").cast("string"), events.schema, MICROS).alias("r")).select("r.*")
        start_append(rows, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return read_appended(spark, f"{root}/table")


@register("scan_sharded_events", """
SELECT user_id, COUNT(*) AS records, CAST(1 AS BIGINT) AS shards FROM events GROUP BY user_id""")
def _scan_sharded_events(spark, sf):
    """The stream as a batch: every key's records, all in one shard."""
    root = shared_dir(spark, "sharded", "events")
    events, records = _event_records(spark, sf)
    put_records(records, root, REGION, "events", shards=8)
    rows = decode_json(read_records(spark, root, REGION, "events"), events.schema, "data", ["shardId"])
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("shardId").alias("shards"))


@register("stream_sharded_latest_posts", with_feeds(f"SELECT {POSTS_COLS} FROM pr", _NULLED))
def _stream_sharded_latest_posts(spark, sf):
    """``latest`` by sequence number: what was put before the first start is skipped, what comes
    between two runs is not."""
    root = shared_dir(spark, "sharded", "posts")
    records = to_records(source_rows(spark, sf, "posts"), STREAM_NAMES["posts"])

    def run():
        src = read_record_stream(spark, root, REGION, STREAM_NAMES["posts"], startingPosition="latest")
        start_append(clean_records(src, "posts"), f"{root}/table", f"{root}/checkpoint").awaitTermination()

    put_records(records, root, REGION, STREAM_NAMES["posts"])
    run()
    put_records(records, root, REGION, STREAM_NAMES["posts"])
    run()
    return read_appended(spark, f"{root}/table")


# --------------------------------------------------------------------------- live join and counts
def _land_part(spark, sf, root, feed, day, part=None):
    """Records of a feed (or of one part of three) as they arrive on ``day``; a heartbeat without rows if ``sf`` is None.
    Returns how many files they are."""
    at = F.lit(DAY0 + timedelta(days=day)).cast("timestamp")
    if sf is None:
        rows = spark.createDataFrame([(STREAM_NAMES[feed], None, None)], "streamName string, partitionKey string, data binary")
    else:
        source = source_rows(spark, sf, feed)
        if part is not None:
            source = source.where(F.pmod(F.col(source.columns[0]), F.lit(3)) == part)
        rows = to_records(source, STREAM_NAMES[feed]).drop("arrivalTimestamp")
    path = f"{root}/{feed}"
    before = file_count(spark, path)
    rows.withColumn("arrivalTimestamp", at).write.mode("append").parquet(path)
    return file_count(spark, path) - before


def _run_join(spark, root, files):
    """Join what waits (up to ``files`` files a feed) in about ``BATCHES`` batches: only a batch's share lies in shuffles,
    and the first one's time lets the others drop the state of the day before."""
    a_batch = max(1, -(-files // BATCHES))
    posts, geo = (read_stream(spark, f"{root}/{feed}", RECORD_SCHEMA, max_files_per_trigger=a_batch) for feed in ("posts", "geo"))
    start_append(join_live(posts, geo), f"{root}/joined", f"{root}/checkpoint-join", sink="atomic").awaitTermination()


def _joined(spark, sf):
    root = shared_dir(spark, "live")
    for day in range(2):
        _run_join(spark, root, max(_land_part(spark, None if day else sf, root, feed, day) for feed in ("posts", "geo")))
    return read_appended(spark, f"{root}/joined")


@register("stream_join_posts_geo", REGISTRY["posts_geo_left"][1])
def _stream_join_posts_geo(spark, sf):
    return _joined(spark, sf)


@register("top_category_by_country_live", REGISTRY["top_category_by_country"][1])
def _top_category_by_country_live(spark, sf):
    joined = _joined(spark, sf)
    counts = joined.groupBy("country", "category").agg(F.count(F.lit(1)).alias("category_count"))
    return Q.top_per_group(counts, ["country"], "category_count").select("country", "category", "category_count")


@register("category_counts_live", with_clean(_COUNTS_BY_COUNTRY))
def _category_counts_live(spark, sf):
    """The feeds in three parts, a day apart; after each the join and the counts go on from their checkpoints."""
    root = shared_dir(spark, "live")
    keys = ["country", "category"]
    for day in range(4):
        files = max(_land_part(spark, sf if day < 3 else None, root, feed, day, day) for feed in ("posts", "geo"))
        _run_join(spark, root, files)
        schema = spark.read.parquet(f"{root}/joined").drop("run", "batch").schema
        joined = read_stream(spark, f"{root}/joined", schema)
        start_counts(joined, keys, f"{root}/counts", f"{root}/checkpoint-counts").awaitTermination()
    return counts_table(joined, keys, f"{root}/counts").read()


# --------------------------------------------------------------------------- dedup beyond the watermark
@register("stream_dedup_ttl_posts", with_clean(f"SELECT {POSTS_COLS} FROM posts"))
def _stream_dedup_ttl_posts(spark, sf):
    """The feed on one day, and whole once more the next: every copy falls, hours behind the
    ten minutes of the watermark, within a record's life of two days."""
    root = shared_dir(spark, "dedup-ttl")
    for day in range(2):
        _land_part(spark, sf, root, "posts", day)
        once = dedup_with_ttl(read_stream(spark, f"{root}/posts", RECORD_SCHEMA), 2 * 24 * 3600)
        start_append(clean_records(once, "posts"), f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return read_appended(spark, f"{root}/table")


# --------------------------------------------------------------------------- incremental cleaning
@register("clean_posts_incremental", with_clean(f"SELECT {POSTS_COLS} FROM posts"))
def _clean_posts_incremental(spark, sf):
    """A part of the feed on the first day, the whole feed (that part once more) on the second."""
    feed = IncrementalFeed(spark, "posts", shared_dir(spark, "incremental"))
    raw = posts_raw(spark, sf)
    feed.add("day 1", raw.where(F.xxhash64("index") % 2 == 0))
    feed.add("day 2", raw)
    return feed.read()


# --------------------------------------------------------------------------- supervisor
@register("stream_supervised_feeds", REGISTRY["stream_three_feeds"][1])
def _stream_supervised_feeds(spark, sf):
    """Three feeds under the supervisor; the posts feed fails at its first batch and is restarted."""
    from postflow.streaming.pipeline import land_records

    roots = {}
    for feed in STREAM_NAMES:
        roots[feed] = shared_dir(spark, "streams", feed)
        land_records(source_rows(spark, sf, feed), f"{roots[feed]}/landing", STREAM_NAMES[feed])
    failed = []

    def start_failing():
        if failed:
            return start_feed(spark, "posts", f"{roots['posts']}/landing", f"{roots['posts']}/table", f"{roots['posts']}/checkpoint")
        failed.append(True)
        src = read_stream(spark, f"{roots['posts']}/landing", RECORD_SCHEMA)
        bad = clean_records(src, "posts").withColumn("category", F.raise_error(F.lit("planted failure")).cast("string"))
        return start_append(bad, f"{roots['posts']}/table", f"{roots['posts']}/checkpoint")

    starts = {f: (lambda f=f: start_feed(spark, f, f"{roots[f]}/landing", f"{roots[f]}/table", f"{roots[f]}/checkpoint"))
              for f in ("geo", "users")}
    states = Supervisor(spark, {"posts": start_failing, **starts}, first_pause=0.1).run()
    if set(states.values()) != {"done"}:
        raise RuntimeError(f"feeds ended as {states}")
    out = None
    for feed, root in roots.items():
        one = read_appended(spark, f"{root}/table").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(feed).alias("feed"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
