"""Incremental cleaning against cleaning the whole history."""

from pyspark.sql import functions as F

from postflow.operators.clean import clean_geo
from postflow.operators.incremental import IncrementalFeed
from postflow.schemas import RAW


def rows(df):
    return sorted(map(str, df.collect()))


def test_days_add_up_to_the_whole(spark, workdir):
    data = [(i, None if i % 5 == 0 else "2020-01-01 00:00:00", None if i % 7 == 0 else i / 3, float(i % 4), f"land{i % 3}") for i in range(60)]
    raw = spark.createDataFrame(data + data[:20] + [(None, None, None, None, None)] * 2, RAW["geo"])
    later = spark.createDataFrame(data[:5] + [(3, "2021-01-01 00:00:00", 1.0, 1.0, "edited")], RAW["geo"])
    feed = IncrementalFeed(spark, "geo", workdir, buckets=4)
    assert feed.read().count() == 0
    assert feed.add("d1", raw) == 61 and feed.add("d2", raw) == 0
    assert feed.add("d3", later) == 1 and feed.add("d3", raw.limit(9)) == 0               # a day that is run again is skipped
    assert feed.add("d4", raw.where("false")) == 0
    assert list(sorted(feed.days())) == ["d1", "d2", "d3", "d4"]
    assert rows(feed.read()) == rows(clean_geo(raw.union(later)))


def test_uncommitted_day_is_unseen(spark, workdir, monkeypatch):
    raw = spark.createDataFrame([(1, None, 1.0, 2.0, "a"), (2, None, 1.0, 2.0, "b")], RAW["geo"])
    feed = IncrementalFeed(spark, "geo", workdir, buckets=2)
    monkeypatch.setattr(feed, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("planted")))
    try:
        feed.add("d1", raw)
    except RuntimeError:
        pass
    assert feed.read().count() == 0
    monkeypatch.undo()
    assert feed.add("d1", raw) == 2 and feed.read().count() == 2


def test_index_reads_only_touched_buckets(spark, workdir):
    raw = spark.range(200).select(F.col("id").alias("ind"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW["geo"].fields[1:]])
    feed = IncrementalFeed(spark, "geo", workdir, buckets=8)
    feed.add("d1", raw)
    some = feed.index([3])
    assert 0 < some.count() < 100 and feed.index().count() == 200
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
