"""Cleaning operators for the three feeds (DataFrame -> DataFrame).

Each ``clean_*`` works on batch and streaming frames and on both input typings
(numbers as JSON numbers or as text, timestamps as text or typed): casts are
NULL-on-failure and timestamps are parsed only when they arrive as text.

Plan shape at scale: everything here is one narrow projection (Catalyst
collapses it into a single codegen stage after the scan) except whole-row
dedup, which is one aggregate on all columns with a map-side partial step, so
copies of a row are merged before the shuffle and a hot group of copies costs
at most one row per map task. Sorting is off by default: a global sort before
a join, group or window is wasted work, as those do not keep order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.functions.cleaning import (
    FOLLOWER_SUFFIXES, POSTS_PLACEHOLDERS, SAVE_LOCATION_PREFIX, TIMESTAMP_FORMAT,
    expand_suffix, join_name, null_if_matches, pack_array, parse_timestamp, split_list,
    strip_text, text_to_int,
)
from postflow.schemas import GEO_COLUMNS, POSTS_COLUMNS, RAW, USERS_COLUMNS

DEDUP_MODES = ("raw", "clean", "none")


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def _is_text(df: DataFrame, name: str) -> bool:
    return _dtype(df, name).typeName() == "string"


def null_placeholders(df: DataFrame, patterns: dict[str, str] = POSTS_PLACEHOLDERS) -> DataFrame:
    """Placeholder text -> NULL, per column by regex search (one projection)."""
    return df.withColumns({c: null_if_matches(F.col(c), p)
                           for c, p in patterns.items() if c in df.columns})


def expand_suffix_int(df: DataFrame, column: str = "follower_count",
                      suffixes: dict = FOLLOWER_SUFFIXES, mode: str = "compat") -> DataFrame:
    """``12k`` / ``3M`` style counts -> int (see ``expand_suffix``)."""
    return df.withColumn(column, expand_suffix(F.col(column), suffixes, mode))


def strip_column(df: DataFrame, column: str = "save_location",
                 pattern: str = SAVE_LOCATION_PREFIX) -> DataFrame:
    return df.withColumn(column, strip_text(F.col(column), pattern))


def split_column(df: DataFrame, column: str = "tag_list", sep: str = ",") -> DataFrame:
    return df.withColumn(column, split_list(F.col(column), sep))


def to_timestamp_column(df: DataFrame, column: str, fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Parse ``column`` when it is text; typed timestamps pass through."""
    if _is_text(df, column):
        return df.withColumn(column, parse_timestamp(F.col(column), fmt))
    return df.withColumn(column, F.col(column).try_cast("timestamp"))


def _check(dedup: str) -> None:
    if dedup not in DEDUP_MODES:
        raise ValueError(f"dedup must be one of {DEDUP_MODES}, not {dedup!r}")


def drop_identical_records(df: DataFrame, feed: str) -> DataFrame:
    """Drop identical records. Identity is over the record's own fields (the
    feed's raw schema) and, for a line that did not parse, its text in
    ``_corrupt_record``. Columns a reader adds about the file — the topic
    partition from partition discovery, file metadata — do not make two copies
    of a record different (the cleaners drop them afterwards)."""
    fields = [f for f in (*RAW[feed].fieldNames(), "_corrupt_record") if f in df.columns]
    extra = [c for c in df.columns if c not in fields]
    return df.dropDuplicates(fields) if extra and fields else df.dropDuplicates()


def clean_posts(df: DataFrame, dedup: str = "raw", sort: bool = False,
                suffix_mode: str = "compat", keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw posts -> clean posts (``POSTS_COLUMNS``).

    ``dedup="raw"`` removes identical raw records first; ``"clean"`` removes
    identical clean rows last (it also merges ``12k`` with ``12000``);
    ``"none"`` keeps every record (streams). ``keep`` carries further columns
    along (a record's arrival time).
    """
    _check(dedup)
    if dedup == "raw":
        df = drop_identical_records(df, "posts")
    df = null_placeholders(df)
    df = df.withColumns({
        "follower_count": expand_suffix(F.col("follower_count"), mode=suffix_mode),
        "index": text_to_int(F.col("index"), _dtype(df, "index")),
        "save_location": strip_text(F.col("save_location")),
        "tag_list": split_list(F.col("tag_list")),
        "downloaded": F.col("downloaded").try_cast("boolean"),
    }).withColumnRenamed("index", "ind").select(*POSTS_COLUMNS, *keep)
    if dedup == "clean":
        df = df.dropDuplicates()
    return df.orderBy("ind") if sort else df


def clean_geo(df: DataFrame, dedup: str = "raw", sort: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw geo -> clean geo (``GEO_COLUMNS``): float coordinates packed into an
    array, timestamp parsed."""
    _check(dedup)
    if dedup == "raw":
        df = drop_identical_records(df, "geo")
    df = to_timestamp_column(df, "timestamp")
    df = df.withColumns({
        "ind": text_to_int(F.col("ind"), _dtype(df, "ind")),
        "coordinates": pack_array(F.col("latitude").try_cast("float"),
                                  F.col("longitude").try_cast("float")),
    }).select(*GEO_COLUMNS, *keep)
    if dedup == "clean":
        df = df.dropDuplicates()
    return df.orderBy("ind") if sort else df


def clean_users(df: DataFrame, dedup: str = "raw", sort: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw users -> clean users (``USERS_COLUMNS``): names joined, timestamp parsed."""
    _check(dedup)
    if dedup == "raw":
        df = drop_identical_records(df, "users")
    df = to_timestamp_column(df, "date_joined")
    df = df.withColumns({
        "ind": text_to_int(F.col("ind"), _dtype(df, "ind")),
        "age": text_to_int(F.col("age"), _dtype(df, "age")),
        "user_name": join_name("first_name", "last_name"),
    }).select(*USERS_COLUMNS, *keep)
    if dedup == "clean":
        df = df.dropDuplicates()
    return df.orderBy("ind") if sort else df


CLEANERS = {"posts": clean_posts, "geo": clean_geo, "users": clean_users}


def clean_all(raw: dict[str, DataFrame], dedup: str = "raw") -> dict[str, DataFrame]:
    return {name: CLEANERS[name](df, dedup=dedup) for name, df in raw.items()}
