"""Registered keys of the quantile sketches.

A sketch draws at random, so its medians are judged by rank: each key gives every group with
its number of values and whether the median lies within the stated bound (for the
sketches twice their 99 % rank error, as many groups are judged at once; for
``percentile_approx`` its documented 1 / accuracy, at the default accuracy).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from postflow.operators.aggregates import bucketize, median_by
from postflow.plans.questions import posts_with
from postflow.plans.catalog import _JOIN_YEAR, _POSTS_USERS, FIXTURE_JOIN_YEARS, posts, register, users
from postflow.plans.live_keys import _land_part
from postflow.plans.oracle import with_clean
from postflow.session import shared_dir
from postflow.sources.files import read_stream
from postflow.streaming.live import join_live
from postflow.streaming.pipeline import RECORD_SCHEMA, read_appended, start_append
from postflow.streaming.sketches import SketchTable, rank_check, rank_error, start_sketches

GROUPS = ["age_group", "post_year"]
VALUE = "follower_count"
SLACK = 2
DEFAULT_ACCURACY = 10000


def _grouped(joined):
    return bucketize(joined, "age", "age_group").select("age_group", F.year("date_joined").alias("post_year"), VALUE)


def _rows(spark, sf):
    return posts_with(posts(spark, sf).select("ind", VALUE), users(spark, sf).select("ind", "age", "date_joined"))


def _in_years():
    return F.col("post_year").between(*FIXTURE_JOIN_YEARS)


def _judged(spark, sf, by, where=None):
    """Three days of rows, each sketched on its day; the medians come from the stored sketches alone."""
    rows = _rows(spark, sf)
    data = _grouped(rows)
    table = SketchTable(spark, shared_dir(spark, "sketches"), data.schema, GROUPS, VALUE)
    for day in range(3):
        table.add(_grouped(rows.where(F.pmod("ind", F.lit(3)) == day)), "days", day)
    medians = table.quantile(by, 0.5, "median", where)
    data = data if where is None else data.where(where)
    return rank_check(data, by, VALUE, medians, "median", 0.5, SLACK * rank_error(table.k))


def _sql(rows, by):
    keys = ", ".join(by)
    return with_clean(f"SELECT {keys}, COUNT(follower_count) AS n, TRUE AS within_bound FROM ({rows}) t GROUP BY {keys}")


_QUESTIONS = {"age": (["age_group"], False), "join_year": (["post_year"], True), "age_and_year": (GROUPS, True)}


def _register(question, by, windowed):
    sql = _sql(_JOIN_YEAR if windowed else _POSTS_USERS, by)

    @register(f"median_followers_by_{question}_sketch", sql)
    def _sketched(spark, sf):
        return _judged(spark, sf, by, _in_years() if windowed else None)

    @register(f"median_followers_by_{question}_default", sql)
    def _default(spark, sf):
        data = _grouped(_rows(spark, sf))
        data = data.where(_in_years()) if windowed else data
        medians = median_by(data, by, VALUE, "median")
        return rank_check(data, by, VALUE, medians, "median", 0.5, 1 / DEFAULT_ACCURACY)


for _q, (_by, _windowed) in _QUESTIONS.items():
    _register(_q, _by, _windowed)


@register("median_followers_by_age_live", _sql(_POSTS_USERS, ["age_group"]))
def _median_followers_by_age_live(spark, sf):
    """Posts and users as two streams, joined, and sketched from the joined stream."""
    root = shared_dir(spark, "live")
    table = None
    for day in range(2):
        for feed in ("posts", "users"):
            _land_part(spark, None if day else sf, root, feed, day)
        left, right = (read_stream(spark, f"{root}/{feed}", RECORD_SCHEMA) for feed in ("posts", "users"))
        start_append(join_live(left, right, feed="users"), f"{root}/joined", f"{root}/checkpoint-join", sink="atomic").awaitTermination()
        schema = spark.read.parquet(f"{root}/joined").drop("run", "batch").schema
        rows = _grouped(read_stream(spark, f"{root}/joined", schema))
        table = table or SketchTable(spark, f"{root}/sketches", rows.schema, GROUPS, VALUE)
        start_sketches(rows, table, f"{root}/checkpoint-sketches").awaitTermination()
    return rank_check(_grouped(read_appended(spark, f"{root}/joined")), ["age_group"], VALUE,
                      table.quantile(["age_group"]), "median", 0.5, SLACK * rank_error(table.k))
