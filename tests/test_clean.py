"""Composite cleaning operators (C1-C3) and their dedup variants."""

from datetime import datetime

import pytest

from postflow.operators.clean import clean_geo, clean_posts, clean_users
from postflow.schemas import GEO_COLUMNS, POSTS_COLUMNS, POSTS_RAW, USERS_COLUMNS

RAW = [
    (1, "u1", "", "My Untitled art", "Ann", "12k", "a,b,,", "image", "Image src error.", 1,
     "Local save in /d/x", "art"),
    (1, "u1", "", "My Untitled art", "Ann", "12k", "a,b,,", "image", "Image src error.", 1,
     "Local save in /d/x", "art"),
    (1, "u1", "", "My Untitled art", "Ann", "12000", "a,b,,", "image", "Image src error.", 1,
     "Local save in /d/x", "art"),
    (2, "u2", "T", "D", "User Info Error", "User Info Error", "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e",
     "video", "http://i", 0, "Local save in /d/y", "food"),
]


@pytest.fixture()
def raw_posts(spark):
    return spark.createDataFrame(RAW, POSTS_RAW)


def test_clean_posts_schema_and_values(raw_posts):
    out = clean_posts(raw_posts, sort=True)
    assert out.columns == POSTS_COLUMNS
    types = dict(out.dtypes)
    assert types["ind"] == "int" and types["follower_count"] == "int"
    assert types["tag_list"] == "array<string>" and types["downloaded"] == "boolean"
    rows = out.collect()
    # raw dedup merges the identical pair, but keeps "12k" and "12000" apart
    assert len(rows) == 3
    first = rows[0]
    assert first.title is None and first.description is None and first.image_src is None
    assert first.tag_list == ["a", "b", "", ""] and first.save_location == "/d/x"
    assert first.follower_count == 12000 and first.downloaded is True
    last = rows[-1]
    assert last.poster_name is None and last.follower_count is None and last.tag_list is None
    assert last.downloaded is False


def test_dedup_late_merges_equivalent_rows(raw_posts):
    assert clean_posts(raw_posts, dedup="clean").count() == 2
    assert clean_posts(raw_posts, dedup="none").count() == 4


def test_bad_dedup_mode(raw_posts):
    with pytest.raises(ValueError):
        clean_posts(raw_posts, dedup="sometimes")


def test_clean_posts_stream_typing(spark):
    """Stream rows carry text numbers; the same cleaner handles them."""
    from postflow.schemas import POSTS_STREAM
    row = (5, "u5", "t", "d", "p", "3M", "x", "image", "s", "1", "Local save in /z", "c")
    out = clean_posts(spark.createDataFrame([row], POSTS_STREAM), dedup="none").collect()[0]
    assert out.ind == 5 and out.follower_count == 3000000 and out.downloaded is True


def test_clean_geo(spark):
    from postflow.schemas import GEO_RAW
    rows = [(7, "2020-01-02 03:04:05", 1.25, None, "X"), (7, "2020-01-02 03:04:05", 1.25, None, "X"),
            (8, "bad", 2.0, 3.0, None)]
    out = clean_geo(spark.createDataFrame(rows, GEO_RAW), sort=True)
    assert out.columns == GEO_COLUMNS
    got = out.collect()
    assert [r.ind for r in got] == [7, 8]
    assert got[0].coordinates == [1.25, None] and got[0].timestamp == datetime(2020, 1, 2, 3, 4, 5)
    assert got[1].timestamp is None and got[1].country is None


def test_clean_users(spark):
    from postflow.schemas import USERS_RAW
    rows = [(3, None, "Lee", 30, "2016-05-01 00:00:00"), (4, "Bo", "Ng", 17, "2016-05-01T00:00:00")]
    out = clean_users(spark.createDataFrame(rows, USERS_RAW), sort=True)
    assert out.columns == USERS_COLUMNS
    got = out.collect()
    assert got[0].user_name is None and got[0].age == 30
    assert got[1].user_name == "Bo Ng" and got[1].date_joined is None


def test_raw_dedup_ignores_reader_columns(spark):
    """The same record read from two topic partitions is one record."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(RAW[:1], POSTS_RAW)
    two = df.withColumn("partition", F.lit(0)).unionByName(df.withColumn("partition", F.lit(1)))
    assert clean_posts(two).count() == 1
    assert clean_posts(two, dedup="none").count() == 2
