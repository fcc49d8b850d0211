"""Quantile sketches: merged batches, any grouping, edge rows, streams."""

import pytest
from pyspark.sql import functions as F

from postflow.streaming.sketches import SketchTable, rank_check, rank_error, sketch_by, start_sketches

ROWS = "a string, b int, v int"


def values(spark, n=30000):
    return spark.range(n).select(F.when(F.col("id") % 3 != 0, F.lit("x")).otherwise(F.lit("y")).alias("a"),
                                 (F.col("id") % 5).cast("int").alias("b"), F.pmod(F.xxhash64("id"), F.lit(100000)).cast("int").alias("v"))


def test_batches_merge_to_any_grouping(spark, workdir):
    df = values(spark)
    table = SketchTable(spark, f"{workdir}/t", df.schema, ["a", "b"], "v", k=256)
    for day in range(4):
        assert table.add(df.where(F.pmod(F.xxhash64("v"), F.lit(4)) == day), "r", day)
    assert not table.add(df, "r", 2)                                      # a batch that is run again is skipped
    for by in (["a", "b"], ["b"], ["a"]):
        for q in (0.1, 0.5, 0.9):
            est = table.quantile(by, q, "e")
            assert est.schema["e"].dataType.simpleString() == "int"
            got = rank_check(df, by, "v", est, "e", q, 2 * rank_error(256)).collect()
            assert got and all(r.within_bound for r in got) and sum(r.n for r in got) == 30000
    whole = table.quantile([], 0.5, "e").collect()
    assert len(whole) == 1 and whole[0].n == 30000
    some = table.quantile(["b"], 0.5, "e", F.col("b") < 2).collect()
    assert {r.b for r in some} == {0, 1}
    assert table.read().agg(F.max(F.length("sketch"))).first()[0] < 8 * 4 * 256


def test_small_groups_are_exact(spark, workdir):
    df = spark.createDataFrame([("x", 1, 5), ("x", 1, 9), ("x", 1, 7), ("x", 2, None), (None, 1, 3), (None, 1, 3), (None, None, None)], ROWS)
    table = SketchTable(spark, f"{workdir}/t", df.schema, ["a", "b"], "v")
    assert table.read().count() == 0 and table.quantile().count() == 0 and table.quantile([]).count() == 0
    table.add(df, "r", 0)
    table.add(df.where("false"), "r", 1)
    got = {(r.a, r.b): (r.n, r.median) for r in table.quantile().collect()}
    assert got == {("x", 1): (3, 7), ("x", 2): (0, None), (None, 1): (2, 3), (None, None): (0, None)}
    assert {r.a: (r.n, r.median) for r in table.quantile(["a"]).collect()} == {"x": (3, 7), None: (2, 3)}


def test_rank_check_finds_a_wrong_median(spark):
    df = values(spark, 5000)
    wrong = spark.createDataFrame([("x", 10), ("y", None)], "a string, e int")
    assert [r.within_bound for r in rank_check(df, ["a"], "v", wrong, "e", 0.5, 0.01).collect()] == [False, False]
    empty = df.withColumn("v", F.lit(None).cast("int"))
    assert not any(r.within_bound for r in rank_check(empty, ["a"], "v", wrong, "e", 0.5, 0.01).where("a = 'x'").collect())
    assert rank_check(empty, ["a"], "v", wrong, "e", 0.5, 0.01).where("a = 'y'").first().within_bound


def test_types(spark, workdir):
    df = spark.range(10).select((F.col("id") / 2).alias("d"), F.col("id").cast("string").alias("s"))
    table = SketchTable(spark, f"{workdir}/t", df.schema, [], "d")
    table.add(df, "r", 0)
    assert table.quantile().first().median == 2.0
    with pytest.raises(TypeError):
        sketch_by(df, [], "s")


def test_stream_is_sketched_once(spark, workdir):
    df = values(spark, 4000)
    df.where("b < 2").write.parquet(f"{workdir}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{workdir}/in")
    table = SketchTable(spark, f"{workdir}/t", df.schema, ["b"], "v")
    start_sketches(stream, table, f"{workdir}/ck").awaitTermination()
    df.where("b >= 2").write.mode("append").parquet(f"{workdir}/in")
    for _ in range(2):
        start_sketches(stream, table, f"{workdir}/ck").awaitTermination()
    assert {r.b: r.n for r in table.quantile().collect()} == {b: 800 for b in range(5)}
