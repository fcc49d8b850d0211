"""Observed writes and topics read as variants."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.operators import quality as QA
from postflow.schemas import GEO_RAW
from postflow.sources.files import read_topic
from postflow.sources.variant import from_variant, load_topic_variant, read_topic_variant
from postflow.streaming import observed as O


def profile(df):
    return {r.column_name: (r.null_count, r.row_count) for r in df.collect()}


def frame(spark, n=1000):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("a"), F.lit(None).cast("string").alias("b.c"), F.col("id").alias("d"))


def test_profile_of_the_written_rows(spark, workdir):
    df = frame(spark)
    got = profile(O.write_profiled(df, lambda d: d.write.parquet(f"{workdir}/t")))
    assert got == {"a": (666, 1000), "b.c": (1000, 1000), "d": (0, 1000)}
    assert spark.read.parquet(f"{workdir}/t").count() == 1000
    ad = df.select("a", "d")
    assert {c: n for c, (n, _) in got.items() if c in "ad"} == {r.column_name: r.null_count for r in QA.null_profile(ad).collect()}
    assert profile(O.write_profiled(ad.where("false"), lambda d: d.write.parquet(f"{workdir}/e"))) == {"a": (0, 0), "d": (0, 0)}
    assert profile(O.write_profiled(ad, lambda d: d.write.parquet(f"{workdir}/one"), ["d"])) == {"d": (0, 1000)}


def test_one_scan(spark, workdir):
    reads = spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    df = spark.range(500).mapInArrow(tick, "id long")
    O.write_profiled(df, lambda d: d.write.parquet(f"{workdir}/t"))
    assert reads.value == 500


def test_stream_profiles_survive_a_failure(spark, workdir, monkeypatch):
    df = frame(spark, 300).select("a", "d")
    df.write.parquet(f"{workdir}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{workdir}/in")
    args = (f"{workdir}/t", f"{workdir}/p", f"{workdir}/ck")
    real = O.commit_batch

    def failing(batch, path, run, epoch, fmt="parquet"):
        if path.endswith("/p"):
            raise RuntimeError("planted")
        return real(batch, path, run, epoch, fmt)
    monkeypatch.setattr(O, "commit_batch", failing)
    with pytest.raises(Exception, match="planted"):
        O.start_profiled(stream, *args).awaitTermination()
    monkeypatch.undo()
    for _ in range(2):                                        # takes the batch up again; then finds nothing new
        O.start_profiled(stream, *args).awaitTermination()
    assert profile(O.read_profile(spark, f"{workdir}/p")) == {"a": (200, 300), "d": (0, 300)}
    df.write.mode("append").parquet(f"{workdir}/in")
    O.start_profiled(stream, *args).awaitTermination()
    assert profile(O.read_profile(spark, f"{workdir}/p")) == {"a": (400, 600), "d": (0, 600)}
    assert spark.read.parquet(f"{workdir}/t").count() == 600


def test_variant_topic(spark, workdir):
    one = spark.createDataFrame([(1, "2020-01-01", 1.5, None, "a"), (2, None, None, 2.0, "b")], GEO_RAW)
    one.write.json(f"{workdir}/g/partition=0")
    explicit = read_topic(spark, f"{workdir}/g", schema=GEO_RAW)
    same = from_variant(read_topic_variant(spark, f"{workdir}/g"), GEO_RAW)
    assert same.columns == explicit.columns and sorted(map(str, same.collect())) == sorted(map(str, explicit.collect()))
    with open(f"{workdir}/more.json", "w") as f:
        f.write('{"ind":"3","latitude":"0.5","country":7,"extra":{"x":[1]}}\n{broken\n[1]\n{"ind":"no","country":{"k":1}}\n')
    spark.read.text(f"{workdir}/more.json").write.text(f"{workdir}/g/partition=1")
    rows, fields = load_topic_variant(spark, f"{workdir}/g", f"{workdir}/out", GEO_RAW)
    got = {(r.ind, r.latitude, r.country, r.partition) for r in rows.where("partition = 1").collect()}
    assert got == {(3, 0.5, "7", 1), (None, None, None, 1), (None, None, '{"k":1}', 1)} and rows.count() == 6
    assert isinstance(fields, str)
    with pytest.raises(ValueError):
        from_variant(read_topic_variant(spark, f"{workdir}/g"), T.StructType([T.StructField("a'b", T.StringType())]))


def test_merged_fields(spark, workdir):
    spark.sql("SELECT 1 AS a, 'x' AS b").write.json(f"{workdir}/g")
    spark.sql("SELECT named_struct('x', 1) AS c, 2 AS a").write.mode("append").json(f"{workdir}/g")
    schema = T.StructType([T.StructField("a", T.LongType())])
    rows, fields = load_topic_variant(spark, f"{workdir}/g", f"{workdir}/out", schema)
    assert sorted(r.a for r in rows.collect()) == [1, 2]
    assert fields == "OBJECT<a: BIGINT, b: STRING, c: OBJECT<x: BIGINT>>"
