"""Aligned sampling with replacement across feeds that share a key.

The feeds are replayed by drawing keys at random *with replacement* and taking
the same key from every feed, so a key may be drawn any number of times (the
source of duplicate records). Drawing ``fraction * n`` times out of ``n`` keys
gives each key a number of draws that is Poisson distributed with mean
``fraction``. Here that number is decided from the key alone: one seeded md5
hash is compared with the cumulative Poisson probabilities, to the last one the
hash can tell apart. No global row numbering, no driver-side draw list: the
sample is a narrow filter + generator per partition, then one key join per
extra feed (AQE-split if a key is hot), and it is reproducible.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.operators.joins import left_join

HASH_SPACE = 16 ** 8   # first 8 hex digits of md5


def draw_thresholds(fraction: float) -> list[int]:
    """Hash values from which a key is drawn at least 1, 2, 3, ... times."""
    if not 0 <= fraction <= 500:
        raise ValueError("fraction must lie in [0, 500]")
    out, term, total, n = [], math.exp(-fraction), 0.0, 0
    while True:
        total += term
        limit = math.floor(total * HASH_SPACE)
        if limit >= HASH_SPACE or (n > fraction and term * HASH_SPACE < 1):
            return out
        out.append(limit)
        n += 1
        term *= fraction / n


def key_hash(key: Column, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def draw_count(key: Column, fraction: float, seed: int) -> Column:
    """Number of times ``key`` is drawn."""
    limits = F.array(*[F.lit(t).cast("bigint") for t in draw_thresholds(fraction)])
    h = key_hash(key, seed)
    return F.size(F.filter(limits, lambda t: t <= h))


def replay_sample(base: DataFrame, others: list[DataFrame] | None = None, key: str = "ind",
                  fraction: float = 1.0, seed: int = 100, skew="aqe") -> DataFrame:
    """Rows of ``base`` repeated by their draw count (``draw`` = 1..n), each
    left-joined with the row(s) of the same key in every frame of ``others``
    (``skew`` as in ``postflow.operators.joins.left_join``)."""
    n = draw_count(F.col(key), fraction, seed)
    out = (base.withColumn("_n", n).where(F.col("_n") > 0)
               .withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n"))
    for other in others or []:
        out = left_join(out, other, key, skew=skew)
    return out
