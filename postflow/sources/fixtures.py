"""Raw feeds derived from the TPC-H-like test tables.

The feeds the library cleans (posts, geo, users) share one key, the post id.
Here they are derived from ``orders ⨝ customer ⨝ nation``: an order is a post,
its customer the poster/user, the customer's nation the post's country. The
placeholder values the cleaning must remove are planted by rules on the keys,
and orders whose key is a multiple of 50 arrive twice (a replayed record), so
that whole-row dedup has work to do. The same formulas exist as SQL in
``postflow.plans.oracle`` for the DuckDB check.

Plan notes: orders ⨝ customer is joined first, then nation. Without cost-based
stats a join's size estimate is the product of its inputs, so joining
customer ⨝ nation first would make the planner pick *orders* as the side to
broadcast; in this order the planner picks customer (when its measured size is
under the broadcast threshold, else a sort-merge join) and then nation (25
rows). The duplicate copy is made by a narrow generator instead of a UNION ALL,
so the base join runs once per feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values planted by the fixture rules (most are the placeholders the cleaning removes).
NO_TITLE = "No Title Data Available"
NO_DESCRIPTION = "No description available"
UNTITLED = "Untitled"
USER_INFO_ERROR = "User Info Error"
NO_TAGS = "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e"
IMAGE_SRC_ERROR = "Image src error."
NO_COUNTS_NATION = 7          # posts of this nation have no follower count at all

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⨝ customer ⨝ nation, with replayed copies (``cp`` 1 or 2); one row per record."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    b = (orders.join(customer, orders.o_custkey == customer.c_custkey)
               .join(nation, customer.c_nationkey == nation.n_nationkey))
    copies = F.when(F.col("o_orderkey") % 50 == 0, 2).otherwise(1)
    return b.select(F.col("o_orderkey").alias("k"), F.col("c_custkey").alias("c"),
                    "o_orderstatus", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment",
                    "n_nationkey", "n_name", F.explode(F.sequence(F.lit(1), copies)).alias("cp"))


def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c, cp = F.col("k"), F.col("c"), F.col("cp")
    return base(spark, sf_dir).select(
        k.alias("index"),
        F.concat(F.lit("u-"), _s(k)).alias("unique_id"),
        F.when(k % 19 == 0, F.lit("")).when(k % 23 == 0, F.lit(NO_TITLE))
         .when((k % 150 == 0) & (cp == 2), F.concat(F.lit("Title "), _s(k), F.lit(" edited")))
         .otherwise(F.concat(F.lit("Title "), _s(k))).alias("title"),
        F.when(k % 13 == 0, F.lit(NO_DESCRIPTION)).when(k % 29 == 0, F.lit(UNTITLED))
         .when(k % 59 == 0, F.lit("An Untitled piece"))
         .otherwise(F.concat(F.lit("Status "), F.col("o_orderstatus"))).alias("description"),
        F.when(k % 11 == 0, F.lit(USER_INFO_ERROR)).otherwise(F.col("c_name")).alias("poster_name"),
        F.when((k % 11 == 0) | (F.col("n_nationkey") == NO_COUNTS_NATION), F.lit(USER_INFO_ERROR))
         .when(k % 100 == 0, F.when(cp == 1, F.lit("12k")).otherwise(F.lit("12000")))
         .when(c % 13 == 0, F.concat(_s(c % 9 + 1), F.when(c % 2 == 0, F.lit(".7k")).otherwise(F.lit(".2k"))))
         .when(c % 17 == 0, F.lit("kk12k"))
         .when(c % 3 == 0, F.concat(_s(c % 900 + 1), F.lit("k")))
         .when(c % 7 == 0, F.concat(_s(c % 9 + 1), F.lit("M")))
         .otherwise(_s(c % 9973)).alias("follower_count"),
        F.when(k % 31 == 0, F.lit(NO_TAGS))
         .when(k % 41 == 0, F.concat(F.col("o_orderpriority"), F.lit(",")))
         .otherwise(F.concat(F.col("o_orderpriority"), F.lit(","), F.col("o_orderstatus"),
                             F.lit(","), F.col("c_mktsegment")))
         .alias("tag_list"),
        F.when(k % 4 == 0, F.lit("video")).otherwise(F.lit("image")).alias("is_image_or_video"),
        F.when(k % 37 == 0, F.lit(IMAGE_SRC_ERROR))
         .otherwise(F.concat(F.lit("https://img.example/"), _s(k))).alias("image_src"),
        F.when(k % 7 == 0, 0).otherwise(1).alias("downloaded"),
        F.concat(F.lit("Local save in /data/"), F.col("c_mktsegment")).alias("save_location"),
        F.col("o_orderpriority").alias("category"),
    )


def geo_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("k"), F.col("n_nationkey")
    same = (k % 100 == 0) & (F.col("cp") == 2) & (n != 12)      # another raw value, the same float
    return base(spark, sf_dir).where(k % 17 != 0).select(
        k.alias("ind"),
        F.when(k % 47 == 0, F.lit("not a time")).otherwise(_s(F.col("o_orderdate"))).alias("timestamp"),
        F.when(k % 43 != 0, (n * 6.5 - 78.0).cast("double") + F.when(same, 1e-9).otherwise(0.0)).alias("latitude"),
        (n * 14.25 - 171.0).cast("double").alias("longitude"),
        F.col("n_name").alias("country"),
    )


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("k"), F.col("c")
    return base(spark, sf_dir).where(k % 23 != 0).select(
        k.alias("ind"),
        F.when(c % 41 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("First"), _s(c % 97))).alias("first_name"),
        F.concat(F.lit("Last"), _s(c % 89)).alias("last_name"),
        (c % 60 + 13 + F.when((k % 100 == 0) & (F.col("cp") == 2), 1).otherwise(0)).alias("age"),
        F.when(k % 53 == 0, F.lit("")).otherwise(_s(F.col("o_orderdate"))).alias("date_joined"),
    )


RAW_FEEDS = {"posts": posts_raw, "geo": geo_raw, "users": users_raw}


def source_rows(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """Rows of ``feed`` typed as the source database holds them (int keys,
    timestamps as timestamps): what a stream producer serialises."""
    raw = RAW_FEEDS[feed](spark, sf_dir)
    fmt = F.lit("yyyy-MM-dd HH:mm:ss")
    if feed == "posts":
        return raw.withColumn("index", F.col("index").cast("int"))
    if feed == "geo":
        return raw.withColumns({"ind": F.col("ind").cast("int"),
                                "timestamp": F.try_to_timestamp("timestamp", fmt)})
    return raw.withColumns({"ind": F.col("ind").cast("int"), "age": F.col("age").cast("int"),
                            "date_joined": F.try_to_timestamp("date_joined", fmt)})


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in RAW_FEEDS.items()}
