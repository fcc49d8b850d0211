"""Connected components of an edge table by alternating large-star / small-star rounds.

Every round is two grouped minima and two joins over the edges; the edges of a
round are checkpointed in the shared folder. A hot node costs one partial
aggregate and a join that adaptive execution can split; nothing is collected per
node and nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import common as C


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Loops and repeated edges do no harm; nodes in no edge are not returned.
    """
    e = C.checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                      .union(low.select("hi", F.col("m").alias("lo"))).distinct())
        e = C.checkpointed(small)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        e.select("lo", "lo").distinct())


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
