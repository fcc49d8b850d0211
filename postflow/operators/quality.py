"""Data-quality checks as DataFrames (so they run distributed and compose).

All checks are single-pass aggregates or narrow projections; none collects rows
to the driver. ``key_uniqueness`` computes the row count and the distinct key
count in one job (count + count_distinct share a scan; the distinct part is a
partial/final aggregate on the key).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_uniqueness(df: DataFrame, key: str = "ind", name: str | None = None) -> DataFrame:
    """One row: ``total_count``, ``distinct_count`` (non-NULL keys) and
    ``is_unique`` (every row has its own key)."""
    out = df.agg(F.count(F.lit(1)).alias("total_count"),
                 F.count_distinct(F.col(key)).alias("distinct_count"))
    out = out.withColumn("is_unique", F.col("total_count") == F.col("distinct_count"))
    return out.select(F.lit(name).alias("feed"), "*") if name else out


def null_count_expr(columns: list[str]) -> Column:
    """Per-row number of NULL fields among ``columns``."""
    return reduce(add, [F.col(c).isNull().cast("int") for c in columns])


def row_null_count(df: DataFrame, name: str = "num_nulls", columns: list[str] | None = None) -> DataFrame:
    return df.withColumn(name, null_count_expr(columns or df.columns))


def drop_rows_by_null_count(df: DataFrame, n: int, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with exactly ``n`` NULL fields."""
    return df.where(null_count_expr(columns or df.columns) != n)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count per column, long form: (``column_name``, ``null_count``).
    One aggregate pass for all columns, then an unpivot of the single row."""
    cols = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def array_null_exists(df: DataFrame, column: str = "coordinates") -> DataFrame:
    """Rows whose array holds a NULL element."""
    return df.where(F.exists(F.col(column), lambda x: x.isNull()))


def array_null_count(df: DataFrame, column: str = "coordinates", name: str = "num_nulls") -> DataFrame:
    """Number of NULL elements of the array per row (NULL for a NULL array)."""
    return df.withColumn(name, F.size(F.filter(F.col(column), lambda x: x.isNull())))


def rows_with_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def schema_report(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The frame's schema as rows (``column_name``, ``data_type``, ``nullable``).
    Metadata only: built from the analysed plan, no data is read."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    schema = T.StructType([T.StructField("column_name", T.StringType(), False),
                           T.StructField("data_type", T.StringType(), False),
                           T.StructField("nullable", T.BooleanType(), False)])
    return spark.createDataFrame(rows, schema)
