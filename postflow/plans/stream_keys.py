"""Registered keys that go through storage: stream decode/clean/append runs,
replays, the JSON topic scan and the table scan.

Each call works in a fresh folder below the session's shared checkpoint
folder (``spark.checkpoint.dir``): records are landed there, a stream runs
with ``availableNow`` into a table there, and the result is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from postflow.operators.clean import clean_posts
from postflow.plans import questions as Q
from postflow.plans.catalog import _COUNTS_BY_COUNTRY, FIXTURE_JOIN_YEARS, FIXTURE_POST_YEARS, REGISTRY, posts, register
from postflow.plans.oracle import (
    GEO_NODEDUP, POSTS_COLS, USERS_NODEDUP, posts_ctes, with_clean, with_feeds,
)
from postflow.schemas import POSTS_RAW
from postflow.session import shared_dir
from postflow.sources.files import read_table, read_topic, read_stream, write_topic
from postflow.sources.fixtures import posts_raw, source_rows
from postflow.streaming.pipeline import (
    RECORD_SCHEMA, clean_records, decode_records, dedup_records, land_records, read_appended,
    run_feeds, start_append, start_feed, to_records,
)

NULLED = posts_ctes("posts_raw", "pr")
STREAM_NAMES = {"posts": "posts-stream", "geo": "geo-stream", "users": "users-stream"}


def _land(spark, sf, feed):
    root = shared_dir(spark, "streams", feed)
    landing = f"{root}/landing"
    land_records(source_rows(spark, sf, feed), landing, STREAM_NAMES[feed])
    return root, landing


def _stream(spark, sf, feed, decode_only=False, replays=1, dedup_delay=None, sink="batches"):
    root, landing = _land(spark, sf, feed)
    table = f"postflow_stream_{feed}_{root[-12:]}" if sink == "table" else f"{root}/table"
    for i in range(replays):
        src = read_stream(spark, landing, RECORD_SCHEMA)
        if dedup_delay:
            src = dedup_records(src, dedup_delay)
        out = decode_records(src, feed) if decode_only else clean_records(src, feed)
        start_append(out, table, f"{root}/checkpoint-{i}", sink=sink).awaitTermination()
    return read_appended(spark, table)


@register("stream_decode_posts", with_feeds("""
SELECT CAST("index" AS INTEGER) AS "index", unique_id, title, description, poster_name, follower_count,
       tag_list, is_image_or_video, image_src, CAST(downloaded AS VARCHAR) AS downloaded,
       save_location, category
FROM posts_raw"""))
def _stream_decode_posts(spark, sf):
    return _stream(spark, sf, "posts", decode_only=True)


@register("stream_append_posts", with_feeds(f"SELECT {POSTS_COLS} FROM pr", NULLED))
def _stream_append_posts(spark, sf):
    return _stream(spark, sf, "posts", sink="table")


@register("stream_append_geo", with_feeds(
    'SELECT ind, country, coordinates, "timestamp" FROM geo_nodedup', GEO_NODEDUP))
def _stream_append_geo(spark, sf):
    return _stream(spark, sf, "geo", sink="table")


@register("stream_append_users", with_feeds(
    "SELECT ind, user_name, age, date_joined FROM users_nodedup", USERS_NODEDUP))
def _stream_append_users(spark, sf):
    return _stream(spark, sf, "users", sink="table")


@register("stream_replay_doubles", with_feeds(
    f"SELECT {POSTS_COLS} FROM pr UNION ALL SELECT {POSTS_COLS} FROM pr", NULLED))
def _stream_replay_doubles(spark, sf):
    return _stream(spark, sf, "posts", replays=2)


@register("stream_three_feeds", with_feeds("""
SELECT 'posts' AS feed, COUNT(*) AS row_count FROM posts_raw
UNION ALL SELECT 'geo', COUNT(*) FROM geo_raw
UNION ALL SELECT 'users', COUNT(*) FROM user_raw"""))
def _stream_three_feeds(spark, sf):
    feeds = {}
    for feed in ("posts", "geo", "users"):
        root, landing = _land(spark, sf, feed)
        feeds[feed] = (landing, f"{root}/table", f"{root}/checkpoint")
    run_feeds(spark, feeds)
    counts = [read_appended(spark, table).agg(F.count(F.lit(1)).alias("row_count"))
                                         .select(F.lit(feed).alias("feed"), "row_count")
              for feed, (_, table, _) in feeds.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("scan_json_topic", with_clean(f"SELECT {POSTS_COLS} FROM posts"))
def _scan_json_topic(spark, sf):
    root = shared_dir(spark, "topics")
    write_topic(posts_raw(spark, sf).withColumn("partition", F.lit(0)), f"{root}/posts",
                partition_col="partition")
    return clean_posts(read_topic(spark, f"{root}/posts", schema=POSTS_RAW))


@register("scan_table", with_clean(f"SELECT {POSTS_COLS} FROM posts"))
def _scan_table(spark, sf):
    path = f"{shared_dir(spark, 'tables')}/posts"
    posts(spark, sf).write.mode("overwrite").parquet(path)
    return read_table(spark, path, "parquet")


@register("stream_dedup_posts", with_clean(f"SELECT {POSTS_COLS} FROM posts"))
def _stream_dedup_posts(spark, sf):
    return _stream(spark, sf, "posts", dedup_delay="1 hour")


@register("top_category_by_country_from_streams", with_clean(f"""
SELECT country, category, category_count FROM (
  SELECT *, rank() OVER (PARTITION BY country ORDER BY category_count DESC) AS rnk
  FROM ({_COUNTS_BY_COUNTRY}) cc) t
WHERE rnk = 1"""))
def _top_category_by_country_from_streams(spark, sf):
    t = _streamed(spark, sf, "posts", "geo")
    return Q.top_category_by_country(t["posts"], t["geo"])


def _streamed(spark, sf, *names):
    """The tables that the feeds' streams have appended, records deduplicated on the way."""
    feeds = {}
    for feed in names:
        root, landing = _land(spark, sf, feed)
        feeds[feed] = (landing, f"{root}/table", f"{root}/checkpoint")
    run_feeds(spark, feeds, dedup_delay="1 hour")
    return {feed: read_appended(spark, feeds[feed][1]) for feed in names}


# The other questions on the streamed tables: question -> (right feed, how it is asked).
_ASKED = {
    "top_category_by_year": ("geo", lambda p, g: Q.top_category_by_year(p, g, FIXTURE_POST_YEARS)),
    "top_poster_by_country": ("geo", lambda p, g: Q.top_poster_by_country(p, g)),
    "country_with_top_poster": ("geo", lambda p, g: Q.country_with_top_poster(p, g)),
    "top_category_by_age": ("users", lambda p, u: Q.top_category_by_age(p, u)),
    "median_followers_by_age": ("users", lambda p, u: Q.median_followers_by_age(p, u, exact=True, sorted_=True)),
    "joined_per_year": ("users", lambda p, u: Q.joined_per_year(p, u, FIXTURE_JOIN_YEARS)),
    "median_followers_by_join_year": ("users", lambda p, u: Q.median_followers_by_join_year(
        p, u, FIXTURE_JOIN_YEARS, exact=True, sorted_=True)),
    "median_followers_by_age_and_year": ("users", lambda p, u: Q.median_followers_by_age_and_year(
        p, u, FIXTURE_JOIN_YEARS, exact=True, sorted_=True)),
}


def _ask_streamed(question, right, ask):
    @register(f"{question}_from_streams", REGISTRY[question][1])
    def _asked(spark, sf):
        t = _streamed(spark, sf, "posts", right)
        return ask(t["posts"], t[right])


for _question, (_right, _ask) in _ASKED.items():
    _ask_streamed(_question, _right, _ask)


# --------------------------------------------------------------------------- stored clean tables

def _stored(spark, sf, feeds=("posts", "geo", "users")):
    from postflow.plans.catalog import geo, users
    from postflow.session import path_bytes
    from postflow.sources.tables import bucket_count, load_clean, store_clean
    buckets = max(bucket_count(path_bytes(spark, f"{sf}/orders.parquet")), spark.sparkContext.defaultParallelism)
    make = {"posts": posts, "geo": geo, "users": users}
    root = shared_dir(spark, "clean")                 # own table names: a result may be read after the next call
    stored = store_clean({f: make[f](spark, sf) for f in feeds}, root, buckets, prefix=f"postflow_{root[-12:]}")
    return load_clean(spark, stored)


@register("top_category_by_country_stored", with_clean(f"""
SELECT country, category, category_count FROM (
  SELECT *, rank() OVER (PARTITION BY country ORDER BY category_count DESC) AS rnk
  FROM ({_COUNTS_BY_COUNTRY}) cc) t
WHERE rnk = 1"""))
def _top_category_by_country_stored(spark, sf):
    t = _stored(spark, sf, ("posts", "geo"))
    return Q.top_category_by_country(t["posts"], t["geo"])


@register("median_followers_by_age_and_year_stored", REGISTRY["median_followers_by_age_and_year"][1])
def _median_followers_by_age_and_year_stored(spark, sf):
    t = _stored(spark, sf, ("posts", "users"))
    return Q.median_followers_by_age_and_year(t["posts"], t["users"], FIXTURE_JOIN_YEARS,
                                              exact=True, sorted_=True)


@register("scan_json_topic_inferred", with_clean(f"SELECT {POSTS_COLS} FROM posts"))
def _scan_json_topic_inferred(spark, sf):
    root = shared_dir(spark, "topics")
    write_topic(posts_raw(spark, sf).withColumn("partition", F.lit(0)), f"{root}/posts",
                partition_col="partition")
    return clean_posts(read_topic(spark, f"{root}/posts", infer=True))


@register("stream_latest_start_posts", with_feeds(f"SELECT {POSTS_COLS} FROM pr", NULLED))
def _stream_latest_start_posts(spark, sf):
    """Records landed before the stream starts are skipped; a later landing of
    the whole feed is taken (once)."""
    root, landing = _land(spark, sf, "posts")
    src = read_stream(spark, landing, RECORD_SCHEMA, starting="latest", checkpoint=f"{root}/checkpoint")
    land_records(source_rows(spark, sf, "posts"), landing, STREAM_NAMES["posts"])
    start_append(clean_records(src, "posts"), f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return read_appended(spark, f"{root}/table")


# --------------------------------------------------------------------------- quarantine

def _quarantined(spark, sf):
    """The posts stream with planted bad payloads (broken text, a text key, none at all)."""
    root = shared_dir(spark, "streams", "posts")
    k = F.col("partitionKey").cast("long")
    bad = (F.when(k % 61 == 0, F.lit("{not json"))
            .when(k % 67 == 0, F.concat(F.lit('{"index":"k'), k.cast("string"), F.lit('"}'))))
    records = to_records(source_rows(spark, sf, "posts"), STREAM_NAMES["posts"]).withColumn(
        "data", F.when(k % 71 == 0, F.lit(None).cast("binary"))
                 .otherwise(F.coalesce(F.encode(bad, "UTF-8"), F.col("data"))))
    records.write.parquet(f"{root}/landing")
    start_feed(spark, "posts", f"{root}/landing", f"{root}/table", f"{root}/checkpoint",
               quarantine_path=f"{root}/bad").awaitTermination()
    return root


@register("stream_quarantine_posts", with_feeds("""
SELECT CAST("index" AS VARCHAR) AS "partitionKey",
       CASE WHEN "index" % 71 = 0 THEN NULL WHEN "index" % 61 = 0 THEN '{not json'
            ELSE '{"index":"k' || CAST("index" AS VARCHAR) || '"}' END AS payload
FROM posts_raw WHERE "index" % 61 = 0 OR "index" % 67 = 0 OR "index" % 71 = 0"""))
def _stream_quarantine_posts(spark, sf):
    return read_appended(spark, f"{_quarantined(spark, sf)}/bad").select("partitionKey", "payload")


@register("stream_quarantine_posts_good", with_feeds(
    f"SELECT {POSTS_COLS} FROM pr WHERE ind % 61 <> 0 AND ind % 67 <> 0 AND ind % 71 <> 0", NULLED))
def _stream_quarantine_posts_good(spark, sf):
    return read_appended(spark, f"{_quarantined(spark, sf)}/table")
