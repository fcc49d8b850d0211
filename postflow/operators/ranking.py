"""Top rows per group.

``top_per_group`` keeps, per group, the rows whose ``order_col`` ranks within
the first ``k`` (``rank()`` semantics: ties are all kept). Two plans:

* ``"join"`` (k = 1 with ties): the best value per group by a partial/final
  aggregate, then a left-semi join back on (group keys, value) with NULL-safe
  equality. Both the aggregate and the join spread a hot group over many
  tasks (the join is hashed on the value too), so no group is ever gathered
  into one task.
* ``"window"``: ``rank()``/``row_number()`` over ``partitionBy(keys)`` and a
  filter. Catalyst plans a *partial* ``WindowGroupLimit`` before the shuffle
  and a final one after it, so each map task sends only its local leaders of
  a group (ties included): a hot group reaches its final task as at most
  (map tasks x leaders) rows, not as its whole row set.

``strategy="auto"`` takes ``"window"`` (fewer stages), or ``"join"`` when there
are no group keys (a window over no keys would put every row in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postflow.operators.joins import null_safe_on


def top_per_group(df: DataFrame, keys: list[str], order_col: str, k: int = 1,
                  ties: bool = True, descending: bool = True,
                  strategy: str = "auto") -> DataFrame:
    """Rows ranked within the first ``k`` of their group by ``order_col``.

    NULL order values sort last when descending and first when ascending (as
    ``rank()`` does), so a group whose values are all NULL keeps every row.
    """
    if strategy == "auto":
        strategy = "window" if keys else "join"
    if not keys and strategy == "window":
        # one window over all rows would run in a single task
        raise ValueError("without group keys use strategy='join' (k=1) or top_overall")
    if strategy == "join":
        if k != 1 or not ties:
            raise ValueError("the join plan computes k=1 with ties only")
        v = F.col(order_col)
        # rank 1 = the largest value (NULLs last) or, ascending, NULL if the
        # group has any NULL (NULLs first), else the smallest value
        best_v = F.max(v) if descending else \
            F.when(F.count_if(v.isNull()) > 0, F.lit(None)).otherwise(F.min(v))
        bk = [f"_top_k{i}" for i in range(len(keys))]
        best = df.groupBy(*keys).agg(best_v.alias("_top_v")) \
                 .select(*[F.col(c).alias(b) for c, b in zip(keys, bk)], "_top_v")
        on = null_safe_on(keys + [order_col], bk + ["_top_v"])
        return df.join(best, on, "left_semi")
    if strategy != "window":
        raise ValueError(f"unknown strategy {strategy!r}")
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
    w = Window.partitionBy(*keys).orderBy(order)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("_rank", fn.over(w)).where(F.col("_rank") <= k).drop("_rank")


def top_overall(df: DataFrame, order_col: str, tie_breakers: list[str] | None = None,
                n: int = 1, descending: bool = True) -> DataFrame:
    """The first ``n`` rows overall (a top-k report; ``TakeOrderedAndProject``,
    which keeps n rows per task and merges them, never a full sort). Ties are
    broken by ``tie_breakers`` ascending so the answer is deterministic."""
    order = [F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()]
    order += [F.col(c).asc_nulls_first() for c in (tie_breakers or [])]
    return df.orderBy(*order).limit(n)
