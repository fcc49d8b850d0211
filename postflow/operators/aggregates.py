"""Grouped aggregates: counts, maxima, medians, bucketing.

Every aggregate here is mergeable, so Spark runs a partial step before the
shuffle (map-side combine): a group holding a third of all rows still sends
one partial row per map task.

Medians come in two kinds:

* approximate (the feed's own definition): ``percentile_approx`` with a
  mergeable sketch; rank error at most ``n / accuracy``;
* exact lower median (the value at rank ``ceil(n/2)`` of the non-NULL values),
  computed by histogram selection: partial/final counts per (group, value),
  summed per (group, ``value >> 16``) bucket; per group the coarse
  counts pick the bucket holding the target rank and a fine pass over the
  histogram rows inside it picks the value. Every window partition holds at
  most 65,536 rows whatever the data size, and the only full-data steps are
  the two pre-aggregated counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.functions.cleaning import AGE_GROUPS, AGE_OTHER, age_group, age_group_order
from postflow.operators.joins import null_safe_on

# Bit shifts of the histogram passes per integral type: each pass narrows the
# candidates to one bucket of 2**16 values.
_SHIFTS = {T.ByteType: [0], T.ShortType: [0], T.IntegerType: [16, 0],
           T.LongType: [48, 32, 16, 0]}


def count_by(df: DataFrame, keys: list[str], alias: str = "count") -> DataFrame:
    """Rows per group; NULL forms a group of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def max_by_group(df: DataFrame, keys: list[str], col: str, alias: str | None = None) -> DataFrame:
    """Largest non-NULL value per group (NULL when the group has none)."""
    return df.groupBy(*keys).agg(F.max(col).alias(alias or col))


def bucketize(df: DataFrame, col: str, name: str = "age_group", groups=AGE_GROUPS,
              other: str = AGE_OTHER, strict: bool = False, order_col: str | None = None) -> DataFrame:
    """Label rows by inclusive ranges of ``col``; ``order_col`` (optional) gets
    the label's position, for sorting groups in range order."""
    out = df.withColumn(name, age_group(F.col(col), groups, other, strict))
    if order_col:
        out = out.withColumn(order_col, age_group_order(F.col(name), groups, other))
    return out


def year_between(df: DataFrame, ts_col: str, lo: int, hi: int, name: str = "post_year") -> DataFrame:
    """Keep rows whose ``ts_col`` falls in the years ``lo``..``hi`` and add the
    year as ``name``. The filter is the equivalent time range
    ``lo-01-01 <= ts < (hi+1)-01-01`` with boundaries of the column's own type,
    so Catalyst pushes it below joins and, on stored tables, into the Parquet
    scan (row groups outside the range are skipped by their min/max)."""
    dtype = df.schema[ts_col].dataType
    start = F.lit(f"{lo:04d}-01-01 00:00:00").cast(dtype)
    end = F.lit(f"{hi + 1:04d}-01-01 00:00:00").cast(dtype)
    ts = F.col(ts_col)
    return df.where((ts >= start) & (ts < end)).withColumn(name, F.year(ts))


def median_by(df: DataFrame, keys: list[str], col: str, alias: str = "median",
              accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """Median of ``col`` per group: ``percentile_approx`` (default) or exact."""
    if exact:
        return exact_quantile_by(df, keys, col, 0.5, alias)
    return df.groupBy(*keys).agg(F.percentile_approx(col, 0.5, accuracy).alias(alias))


def exact_quantile_by(df: DataFrame, keys: list[str], col: str, q: float,
                      alias: str = "quantile") -> DataFrame:
    """Exact lower ``q``-quantile of an integral column per group: the value at
    rank ``max(1, ceil(q * n))`` among the group's ``n`` non-NULL values, NULL
    when there are none. Every group of ``df`` appears once."""
    dtype = df.schema[col].dataType
    shifts = _SHIFTS.get(type(dtype))
    if shifts is None:
        raise TypeError(f"exact quantile needs an integral column, {col} is {dtype.simpleString()}")
    g = [f"_g{i}" for i in range(len(keys))]
    src = df.select(*[F.col(k).alias(a) for k, a in zip(keys, g)], F.col(col).alias("_v"))
    hist = src.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))

    def bucket(shift: int):
        return F.shiftright("_v", shift) if shift else F.col("_v")

    def choose(level: DataFrame) -> DataFrame:
        # level: (g, _b, _bc, _r). Keep the bucket whose running count first
        # reaches the target rank ``_r``; NULL ``_r`` marks a group without values,
        # which keeps its single NULL bucket.
        upto = Window.partitionBy(*g).orderBy(F.col("_b").asc_nulls_last()) \
                     .rowsBetween(Window.unboundedPreceding, 0)
        cum = F.sum(F.when(F.col("_b").isNotNull(), F.col("_bc"))).over(upto)
        before = F.col("_cum") - F.col("_bc")
        return (level.withColumn("_cum", cum)
                     .where((F.col("_b").isNotNull() & (before < F.col("_r"))
                             & (F.col("_r") <= F.col("_cum"))) | F.col("_r").isNull())
                     .select(*g, "_b", (F.col("_r") - before).alias("_r")))

    # Pass 1: coarse buckets; NULL values form a NULL bucket that carries no rank.
    whole = Window.partitionBy(*g)
    n = F.sum(F.when(F.col("_b").isNotNull(), F.col("_bc"))).over(whole)
    # summed from the histogram, so the rows (and the joins below them) are read once
    # and the histogram's exchange serves both passes
    level = (hist.groupBy(*g, bucket(shifts[0]).alias("_b")).agg(F.sum("_c").alias("_bc"))
                 .withColumn("_n", n)
                 .withColumn("_r", F.when(F.col("_n") > 0,
                                          F.greatest(F.ceil(F.lit(q) * F.col("_n")), F.lit(1)))))
    chosen = choose(level)

    prev = shifts[0]
    for shift in shifts[1:]:
        # Pass i: histogram rows inside the chosen bucket (NULL-safe match, so a
        # group without values keeps its NULL row), re-bucketed finer. The match
        # adds no filter below the histogram, so its shuffle is reused.
        t = [f"_t{i}" for i in range(len(g))]
        pick = chosen.select(*[F.col(a).alias(x) for a, x in zip(g, t)],
                             F.col("_b").alias("_pb"), F.col("_r").alias("_pr"))
        same_bucket = bucket(prev).eqNullSafe(F.col("_pb"))
        on = same_bucket if not g else null_safe_on(g, t) & same_bucket
        inside = hist.join(pick, on, "inner")
        inside = inside.select(*g, "_v", "_c", F.col("_pr").alias("_r"))
        if shift:
            level = inside.groupBy(*g, bucket(shift).alias("_b"), "_r").agg(F.sum("_c").alias("_bc"))
        else:  # histogram rows are already one per (group, value)
            level = inside.select(*g, F.col("_v").alias("_b"), F.col("_c").alias("_bc"), "_r")
        chosen = choose(level)
        prev = shift
    return chosen.select(*[F.col(a).alias(k) for a, k in zip(g, keys)],
                         F.col("_b").cast(dtype).alias(alias))
