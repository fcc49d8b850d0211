"""Data-quality checks."""

from postflow.operators import quality as QA


def test_key_uniqueness(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "ind int")
    r = QA.key_uniqueness(df, "ind", "posts").collect()[0]
    assert (r.feed, r.total_count, r.distinct_count, r.is_unique) == ("posts", 4, 2, False)
    r = QA.key_uniqueness(spark.createDataFrame([(1,), (2,)], "ind int")).collect()[0]
    assert r.is_unique is True


def test_row_null_count_and_drop(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, None), (1, 2, 3)], "a int, b int, c int")
    assert [r.num_nulls for r in QA.row_null_count(df).collect()] == [2, 3, 0]
    assert QA.drop_rows_by_null_count(df, 3).count() == 2


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    got = {r.column_name: r.null_count for r in QA.null_profile(df).collect()}
    assert got == {"a": 1, "b": 2}


def test_array_nulls(spark):
    df = spark.createDataFrame([(1, [1.0, None]), (2, [1.0, 2.0]), (3, None)], "ind int, coordinates array<float>")
    assert [r.ind for r in QA.array_null_exists(df).collect()] == [1]
    got = {r.ind: r.num_nulls for r in QA.array_null_count(df).collect()}
    assert got == {1: 1, 2: 0, 3: None}
    assert [r.ind for r in QA.array_null_count(df).where("num_nulls > 0").collect()] == [1]


def test_rows_with_null_and_distinct(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "x")], "ind int, d string")
    assert [r.ind for r in QA.rows_with_null(df, "d").collect()] == [2]
    assert sorted(r.d or "" for r in QA.distinct_values(df, "d").collect()) == ["", "x"]


def test_schema_report(spark):
    df = spark.createDataFrame([(1, ["a"])], "ind int, tags array<string>")
    got = [tuple(r) for r in QA.schema_report(spark, df).collect()]
    assert got == [("ind", "int", True), ("tags", "array<string>", True)]
