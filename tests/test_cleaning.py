"""Cleaning rules on literal frames: NULL, empty and each quirk."""

from datetime import datetime

from pyspark.sql import functions as F

from postflow.functions.cleaning import (
    POSTS_PLACEHOLDERS, age_group, age_group_order, expand_suffix, join_name, null_if_matches,
    pack_array, parse_timestamp, split_list, strip_text, text_to_int,
)
from postflow.operators.clean import null_placeholders


def col_values(df, c="v"):
    return [r[0] for r in df.select(c).collect()]


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"s {dtype}")


def test_placeholder_search_anywhere(spark):
    df = one_col(spark, ["My Untitled art", "Nice", None, "No description available"])
    out = col_values(df.select(null_if_matches(F.col("s"), POSTS_PLACEHOLDERS["description"]).alias("v")))
    assert out == [None, "Nice", None, None]


def test_title_empty_becomes_null(spark):
    df = one_col(spark, ["", "No Title Data Available", "A title", None])
    out = col_values(df.select(null_if_matches(F.col("s"), POSTS_PLACEHOLDERS["title"]).alias("v")))
    assert out == [None, None, "A title", None]


def test_image_src_dot_is_wildcard(spark):
    df = one_col(spark, ["Image src error.", "Image src error", "Image src errorX", "http://x"])
    out = col_values(df.select(null_if_matches(F.col("s"), POSTS_PLACEHOLDERS["image_src"]).alias("v")))
    # without a character after "error" the pattern does not match
    assert out == [None, "Image src error", None, "http://x"]


def test_null_placeholders_only_touches_present_columns(spark):
    df = spark.createDataFrame([("User Info Error", "x")], "poster_name string, other string")
    row = null_placeholders(df).collect()[0]
    assert row.poster_name is None and row.other == "x"


def test_expand_suffix_compat(spark):
    vals = ["12k", "3M", "987", "User Info Error", None, "1.2k", "12K", "kk12k", "", " 42 "]
    out = col_values(one_col(spark, vals).select(expand_suffix(F.col("s")).alias("v")))
    assert out == [12000, 3000000, 987, None, None, 1, None, 12000, None, 42]


def test_expand_suffix_exact(spark):
    vals = ["12k", "3M", "1.2k", "2.5M", "987", "x", None]
    out = col_values(one_col(spark, vals).select(expand_suffix(F.col("s"), mode="exact").alias("v")))
    assert out == [12000, 3000000, 1200, 2500000, 987, None, None]


def test_expand_suffix_overflow_is_null(spark):
    out = col_values(one_col(spark, ["99999999999", "3000M"]).select(expand_suffix(F.col("s")).alias("v")))
    assert out == [None, None]


def test_text_to_int_truncates_fraction(spark):
    out = col_values(one_col(spark, ["12.7", "-3.9", "abc"]).select(text_to_int(F.col("s")).alias("v")))
    assert out == [12, -3, None]


def test_strip_every_occurrence(spark):
    df = one_col(spark, ["Local save in /data/a", "x Local save in y Local save in z", None])
    assert col_values(df.select(strip_text(F.col("s")).alias("v"))) == ["/data/a", "x y z", None]


def test_split_keeps_trailing_empty_parts(spark):
    df = one_col(spark, ["a,b,,", "", None])
    assert col_values(df.select(split_list(F.col("s")).alias("v"))) == [["a", "b", "", ""], [""], None]


def test_pack_array_never_null(spark):
    df = spark.createDataFrame([(1.5, None), (None, None)], "a double, b double")
    out = col_values(df.select(pack_array(F.col("a").cast("float"), "b").alias("v")))
    assert out == [[1.5, None], [None, None]]


def test_join_name_null_if_any_part_null(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee"), ("Ann", None)], "f string, l string")
    assert col_values(df.select(join_name("f", "l").alias("v"))) == ["Ann Lee", None, None]


def test_parse_timestamp_strict_pattern(spark):
    df = one_col(spark, ["2020-01-02 03:04:05", "", "2020-01-02T03:04:05", "2020-01-02 03:04:05.123", None])
    out = col_values(df.select(parse_timestamp(F.col("s")).alias("v")))
    assert out == [datetime(2020, 1, 2, 3, 4, 5), None, None, None, None]


def test_age_groups_boundaries(spark):
    ages = [None, 10, 17, 18, 24, 25, 35, 36, 50, 51]
    df = one_col(spark, ages, "int")
    out = col_values(df.select(age_group(F.col("s")).alias("v")))
    assert out == ["50+", "50+", "50+", "18-24", "18-24", "25-35", "25-35", "36-50", "36-50", "50+"]
    strict = col_values(df.select(age_group(F.col("s"), strict=True).alias("v")))
    assert strict == [None, None, None, "18-24", "18-24", "25-35", "25-35", "36-50", "36-50", None]
    order = col_values(df.select(age_group_order(age_group(F.col("s"))).alias("v")))
    assert order == [4, 4, 4, 1, 1, 2, 2, 3, 3, 4]


def test_boolean_cast_null_on_bad_text(spark):
    df = one_col(spark, ["1", "0", "2", "true", None])
    assert col_values(df.select(F.col("s").try_cast("boolean").alias("v"))) == [True, False, None, True, None]
