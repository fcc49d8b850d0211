"""Left joins on a key that survive a hot key on either side.

AQE splits a skewed partition of the *preserved* (left) side of a left outer
join, but it cannot split the right side: if one key holds a third of the
right rows, that key's task receives all of them. ``left_join(skew="salt")``
handles that case exactly:

* hot keys = keys with more than ``hot_rows`` rows on the right, found by a
  partial/final count (so at most ``rows(right) / hot_rows`` keys);
* right rows of hot keys get a deterministic salt in ``[0, buckets)`` from a
  hash of the whole row (stable when a lost task is recomputed), left rows of
  hot keys are replicated once per salt, and the two meet on (key, salt): each
  (left, right) pair still meets exactly once, now spread over ``buckets``
  tasks;
* every other row takes the plain left join. A hot key has right rows by
  definition, so no left row of it can be unmatched and the union is exact.

``skew="aqe"`` (default) is the plain join, relying on AQE for the left side.
The salted form costs one extra counting pass over the right side and splits
both sides against the hot-key set (semi/anti joins, which the planner
broadcasts when the set is small, as it is by construction); choose it where
a key can hold a large share of the right side's rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Salt:
    """Settings of the salted join: keys with more than ``hot_rows`` right rows
    are spread over ``buckets`` salts. ``skew=Salt(...)`` anywhere a ``skew``
    mode is taken; ``skew="salt"`` means ``Salt()``."""
    hot_rows: int = 1_000_000
    buckets: int = 64


def null_safe_on(left_cols: list[str], right_cols: list[str]):
    """``l1 <=> r1 AND l2 <=> r2 ...`` (NULL keys match each other)."""
    cond = None
    for a, b in zip(left_cols, right_cols):
        c = F.col(a).eqNullSafe(F.col(b))
        cond = c if cond is None else cond & c
    return cond


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys holding more than ``hot_rows`` rows of ``df`` (partial count first)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(key)


def left_join(left: DataFrame, right: DataFrame, key: str, skew: str | Salt = "aqe",
              hot_rows: int | None = None, buckets: int | None = None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING (``key``)."""
    if skew == "aqe":
        return left.join(right, on=key, how="left")
    if skew == "salt":
        skew = Salt()
    if not isinstance(skew, Salt):
        raise ValueError(f"unknown skew mode {skew!r}")
    hot_rows = skew.hot_rows if hot_rows is None else hot_rows
    buckets = skew.buckets if buckets is None else buckets
    hot = hot_keys(right, key, hot_rows)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in right.columns]), F.lit(buckets)).cast("int")
    right_hot = right.join(hot, key, "left_semi").withColumn("_salt", salt)
    left_hot = (left.join(hot, key, "left_semi")
                    .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))))
    joined_hot = left_hot.join(right_hot, [key, "_salt"], "inner").drop("_salt")
    joined_cold = left.join(hot, key, "left_anti").join(right.join(hot, key, "left_anti"), key, "left")
    return joined_hot.unionByName(joined_cold)
