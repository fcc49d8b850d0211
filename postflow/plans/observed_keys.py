"""Registered keys of the observed writes and of the topics read as variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from postflow.operators.clean import clean_posts
from postflow.plans.catalog import posts, register
from postflow.plans.oracle import POSTS_COLS, posts_ctes, with_clean, with_feeds
from postflow.plans.stream_keys import STREAM_NAMES
from postflow.schemas import POSTS_COLUMNS, POSTS_RAW
from postflow.session import shared_dir
from postflow.sources.files import read_stream, write_topic
from postflow.sources.fixtures import posts_raw, source_rows
from postflow.sources.variant import load_topic_variant
from postflow.streaming.observed import read_profile, start_profiled, write_profiled
from postflow.streaming.pipeline import RECORD_SCHEMA, clean_records, land_records


def _profile_sql(table):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, COUNT(*) AS row_count FROM {table}"
        for c in POSTS_COLUMNS)


@register("null_profile_observed", with_clean(_profile_sql("posts")))
def _null_profile_observed(spark, sf):
    """The profile of the clean posts, from the pass that writes their table."""
    return write_profiled(posts(spark, sf), lambda d: d.write.parquet(f"{shared_dir(spark, 'profiled')}/posts"))


@register("stream_null_profile_observed", with_feeds(_profile_sql("pr"), posts_ctes("posts_raw", "pr")))
def _stream_null_profile_observed(spark, sf):
    """The same for a stream: two landings, each batch profiled as it is appended."""
    root = shared_dir(spark, "profiled")
    rows = source_rows(spark, sf, "posts")
    half = F.pmod(F.col("index"), F.lit(2)) == 0
    for part in (rows.where(half), rows.where(~half)):
        land_records(part, f"{root}/landing", STREAM_NAMES["posts"])
        src = clean_records(read_stream(spark, f"{root}/landing", RECORD_SCHEMA), "posts")
        start_profiled(src, f"{root}/table", f"{root}/profile", f"{root}/checkpoint").awaitTermination()
    return read_profile(spark, f"{root}/profile")


@register("scan_json_topic_variant", with_clean(f"SELECT {POSTS_COLS} FROM posts"))
def _scan_json_topic_variant(spark, sf):
    """Files with different fields: half of the topic writes its numbers as text and has a nested field more."""
    root = shared_dir(spark, "topics")
    raw = posts_raw(spark, sf).withColumn("partition", F.lit(0))
    half = F.pmod(F.col("index"), F.lit(2)) == 0
    write_topic(raw.where(half), f"{root}/posts", partition_col="partition")
    other = raw.where(~half).withColumns({"index": F.col("index").cast("string"), "extra": F.struct("category", "downloaded")})
    write_topic(other, f"{root}/posts", partition_col="partition")
    return clean_posts(load_topic_variant(spark, f"{root}/posts", f"{root}/rows", POSTS_RAW)[0])
