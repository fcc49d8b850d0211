"""Quantiles from stored, mergeable sketches (KLL).

``sketch_by`` makes one sketch per group; partial sketches are merged after the shuffle,
so a group holding a third of the rows still sends one small sketch per map task.
``SketchTable`` keeps a sketch per (group, batch), committed once per batch as by
``commit_batch``. A quantile merges the stored sketches and reads no row of an old
batch again, and one table answers every grouping by a subset of its keys: medians by age
group, by year and by both come from sketches per (age group, year).

A sketch keeps some ``3 k`` values whatever it has seen and is exact up to about ``k``.
Its rank error is at most ``rank_error(k)`` of the group's size with 99 % confidence
(0.44 % for the default k), merged or not.

Defined results: NULLs are not counted; a group without any value has ``n`` 0 and a NULL
quantile; an empty table has no groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postflow.operators.joins import null_safe_on
from postflow.streaming.keyed import commit_batch
from postflow.streaming.pipeline import SINK_PARTITIONS, _run_id
from postflow.session import _file_system

K = 1024
SKETCH, SIZE = "sketch", "n"
_KINDS = {T.ByteType: "bigint", T.ShortType: "bigint", T.IntegerType: "bigint", T.LongType: "bigint",
          T.FloatType: "float", T.DoubleType: "double"}


def rank_error(k: int = K) -> float:
    """Rank error of a quantile as a share of the group's size, 99 % confidence."""
    return 2.296 / k ** 0.9021


def _kind(dtype: T.DataType) -> str:
    if type(dtype) not in _KINDS:
        raise TypeError(f"a quantile sketch needs a number, not {dtype.simpleString()}")
    return _KINDS[type(dtype)]


def sketch_by(df: DataFrame, keys: list[str], col: str, k: int = K) -> DataFrame:
    """(keys, ``sketch``, ``n``): a sketch of the non-NULL values of ``col`` per group."""
    make = getattr(F, f"kll_sketch_agg_{_kind(df.schema[col].dataType)}")
    return df.groupBy(*keys).agg(make(col, F.lit(k)).alias(SKETCH), F.count(col).alias(SIZE))


def merge_sketches(sketches: DataFrame, keys: list[str], kind: str = "bigint", k: int = K) -> DataFrame:
    """Stored sketches merged to one per group of ``keys``; NULL where the group has no value."""
    merge = getattr(F, f"kll_merge_agg_{kind}")
    some = F.when(F.col(SIZE) > 0, F.col(SKETCH))
    merged = sketches.groupBy(*keys).agg(merge(some, F.lit(k)).alias(SKETCH), F.sum(SIZE).alias(SIZE))
    return merged.where(F.col(SIZE).isNotNull())        # no keys and no rows: no group


def quantile_of(kind: str, q: float) -> Column:
    """The ``q``-quantile of column ``sketch``, NULL where ``n`` is 0."""
    get = getattr(F, f"kll_sketch_get_quantile_{kind}")
    return F.when(F.col(SIZE) > 0, get(SKETCH, F.lit(q)))


def rank_check(df: DataFrame, keys: list[str], col: str, estimates: DataFrame, estimate: str,
               q: float, bound: float, name: str = "within_bound") -> DataFrame:
    """(keys, n, ``name``): whether each group's estimate lies within ``bound`` x n ranks (one at
    least) of the ``q``-quantile of ``col``; a group without values must have a NULL estimate."""
    g = [f"_g{i}" for i in range(len(keys))]
    right = estimates.select(*[F.col(k).alias(a) for k, a in zip(keys, g)], F.col(estimate).alias("_e"))
    # values first, so a hot group meets its estimate as counted values
    counted = df.groupBy(*keys, F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    met = counted.join(right, null_safe_on(keys, g), "left")
    tally = met.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("_v") < F.col("_e"), F.col("_c"))), F.lit(0)).alias("_below"),
        F.coalesce(F.sum(F.when(F.col("_v") <= F.col("_e"), F.col("_c"))), F.lit(0)).alias("_upto"),
        F.max("_e").alias("_e"))
    slack = F.greatest(F.lit(bound) * F.col("n"), F.lit(1.0))
    near = (F.col("_below") <= q * F.col("n") + slack) & (F.col("_upto") >= q * F.col("n") - slack)
    good = F.when(F.col("n") == 0, F.col("_e").isNull()).otherwise(F.coalesce(near, F.lit(False)))
    return tally.select(*keys, "n", good.alias(name))


class SketchTable:
    """Sketches of column ``col`` per (``keys``, batch) at ``path``; ``like`` gives the columns' types."""

    def __init__(self, spark: SparkSession, path: str, like: T.StructType, keys: list[str], col: str, k: int = K):
        self.spark, self.path, self.keys, self.col, self.k = spark, path.rstrip("/"), keys, col, k
        self.kind, self.value_type = _kind(like[col].dataType), like[col].dataType
        self.schema = T.StructType([like[x] for x in keys] + [T.StructField(SKETCH, T.BinaryType(), True), T.StructField(SIZE, T.LongType(), True)])

    def add(self, rows: DataFrame, run: str, epoch: int) -> bool:
        """Sketch the rows of one batch and commit them; False if this (run, epoch) was committed before."""
        return commit_batch(sketch_by(rows, self.keys, self.col, self.k), self.path, run, epoch)

    def read(self) -> DataFrame:
        """The stored sketches, one row per group and batch."""
        fs = _file_system(self.spark, self.path)
        if not fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).drop(*SINK_PARTITIONS)

    def quantile(self, by: list[str] | None = None, q: float = 0.5, name: str = "median", where: Column | None = None) -> DataFrame:
        """(``by``, n, ``name``) for groups by some of the keys (all by default); ``where`` filters groups by keys."""
        by = self.keys if by is None else by
        held = self.read() if where is None else self.read().where(where)
        merged = merge_sketches(held, by, self.kind, self.k)
        return merged.select(*by, SIZE, quantile_of(self.kind, q).cast(self.value_type).alias(name))


def start_sketches(df: DataFrame, table: SketchTable, checkpoint: str, trigger: str | None = "availableNow") -> StreamingQuery:
    """Keep the sketches of a stream: each batch is sketched once and committed once; no state is held."""
    run = _run_id(df.sparkSession, checkpoint)
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.foreachBatch(lambda batch, epoch: table.add(batch, run, epoch) and None).start()
