"""Helpers shared by the operators of this package.

* ``pick`` selects and renames the needed columns first, so extra input columns
  can carry any name.
* ``write_chunks`` stores documents as rows of a few MB (Arrow IPC, zstd) in a
  bucketed table of the shared folder. Operators that must visit the texts
  several times read it back by ``chunk_id`` without shuffling the texts again.
* ``map_columns`` appends computed columns to whole rows.
"""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from postflow.session import checkpoint_root

CHUNK_BYTES = 8 << 20
BATCH_ROWS = 1000
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
MAX_BUCKETS = 100_000       # what Spark allows a table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, doc_id="id")``: only the named columns, renamed."""
    return df.select(*[col(src).alias(dst) for dst, src in columns.items()])


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use in any letter case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def shared_uri(spark: SparkSession, kind: str) -> str:
    """A fresh path below the cluster's shared folder (not created here)."""
    return f"{checkpoint_root(spark).rstrip('/')}/postflow-llm/{kind}-{uuid.uuid4().hex[:16]}"


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def small_batches(spark: SparkSession) -> None:
    """Rows here hold whole texts, so Arrow batches of Spark's default of 10,000 rows are
    too large for small executors: take ``BATCH_ROWS``, unless the session sets its own."""
    if BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts lineage, survives lost executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def sampled_ids(rows: DataFrame, per_lang: int, seed: int) -> DataFrame:
    """(doc_id) of the ``per_lang`` ids of smallest hash in each language of ``rows`` (doc_id, lang).

    Only hashes that the language's number of ids lets expect among four times as
    many are ranked, each id once, so a ranking task holds some ``4 * per_lang`` rows whatever
    the table's size and however often an id is repeated. Null languages count as the empty
    one; null ids are not chosen.
    """
    keyed = rows.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"),
                        (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / float(1 << 53)).alias("h"))
    counts = keyed.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")).collect()     # one row per language
    if not counts:
        return rows.select("doc_id").where("false")
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], 4.0 * per_lang / max(1, r["ids"]))])
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    return (keyed.where(F.col("h") < share[F.col("lang")]).dropDuplicates(["lang", "doc_id"]).withColumn("rank", F.row_number().over(order))
                 .where(F.col("rank") <= per_lang).select("doc_id").distinct())


def narrowed(rows: DataFrame, ids: DataFrame, key: str = "doc_id", most_bits: int = 1 << 27) -> DataFrame:
    """``rows`` without most of those whose key is not among ``ids`` (``key``): what must be shuffled to
    meet ``ids`` is no longer the whole table. An exact join has to follow.

    A key's hash names one bit of a broadcast bitmap; there are 32 bits an id, ``most_bits`` (16 MB) at
    most, so the broadcast is bounded and a larger table only lets more of the other rows through. Keys
    whose types differ, or have several forms of one value, are not looked up: all their rows stay.
    """
    kind = rows.schema[key].dataType
    if kind not in (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.StringType()) or ids.schema[key].dataType != kind:
        return rows
    bits = min(most_bits, 1 << max(15, (32 * ids.count()).bit_length()))
    at = F.pmod(F.xxhash64(col(key)), F.lit(bits)) + 1
    marks = checkpointed(ids.groupBy(F.bitmap_bucket_number(at).alias("part"))
                            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")))
    part, marked = fresh_name(rows, "part"), fresh_name(rows, "bits")
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col(marked), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn(part, F.bitmap_bucket_number(at)).join(
        F.broadcast(marks.select(F.col("part").alias(part), F.col("bits").alias(marked))), part)
    return found.where(F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1).select(*[col(c) for c in rows.columns])


WORKER_CACHES: list[dict] = []       # the caches that modules keep in a Python worker


def drop_caches() -> None:
    """Empty what tasks of other operators have left in this Python worker. Workers are reused in turn, and there are
    several a core where a stage chains Python functions, so what each still holds adds up beside the heap."""
    held = [c for c in WORKER_CACHES if c]
    for c in held:
        c.clear()
    if held:
        gc.collect()                     # their entries may refer to each other
    release_memory()


def release_memory() -> None:
    """Give freed memory of Arrow and numpy back to the system. Workers are reused, and what one
    task has freed would otherwise count beside the next one's."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)        # glibc only
    if trim is not None:
        trim(0)


def texts_of(column) -> list[str]:
    """Python strings of an Arrow column; null reads as the empty string."""
    return [t or "" for t in column.to_pylist()]


def map_columns(df: DataFrame, inputs: list[str], outputs: dict[str, T.DataType],
                fn: Callable[[], Callable[..., list]], rows: int = 2000) -> DataFrame:
    """Append columns computed from ``inputs``; every row keeps all its columns, but a
    column with the name of an output is replaced.

    ``fn()`` runs once per task and returns a function that takes one Arrow
    array per input and returns one list or array per output column.
    """
    small_batches(df.sparkSession)
    new = {k.lower() for k in outputs}
    stay = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in new]
    schema = T.StructType([*(df.schema.fields[i] for i in stay), *[T.StructField(k, v, True) for k, v in outputs.items()]])
    at = [df.columns.index(c) for c in inputs]
    kinds = [f.type for f in to_arrow_schema(T.StructType([T.StructField(k, v) for k, v in outputs.items()]))]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for whole in batches:
            for i in range(0, whole.num_rows, rows):
                b = whole.slice(i, rows)
                made = work(*[b.column(j) for j in at])
                made = [m if isinstance(m, pa.Array) else pa.array(m, k) for m, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([*(b.column(j) for j in stay), *made], names=names)

    return df.mapInArrow(run, schema)


# ------------------------------------------------------------------ chunk table
def pack_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_batch(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(pa.py_buffer(blob)) as r:
        return r.read_next_batch()


def write_chunks(df: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of ``df`` as table rows (chunk_id, docs), about ``chunk_bytes`` each.

    The table is written once, bucketed by ``chunk_id``, below the shared
    folder: later passes group by ``chunk_id`` without a shuffle of the texts
    and see the same chunks even if executors are lost in between.
    """
    spark = df.sparkSession
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def emit():
            nonlocal held, size, seq
            t = pa.Table.from_batches(held).combine_chunks()
            out = pa.RecordBatch.from_pydict({
                "chunk_id": pa.array([(part << 32) | seq], pa.int64()),
                "docs": pa.array([pack_batch(t.to_batches()[0])], pa.binary())})
            held, size, seq = [], 0, seq + 1
            return out

        for whole in batches:
            step = max(1, int(whole.num_rows * chunk_bytes / max(1, whole.nbytes) / 4))
            for i in range(0, whole.num_rows, step):
                b = whole.slice(i, step)
                held.append(b)
                size += b.nbytes
                if size >= chunk_bytes:
                    yield emit()
        if held:
            yield emit()

    name = f"postflow_chunks_{uuid.uuid4().hex[:16]}"
    (df.mapInArrow(run, "chunk_id long, docs binary").write.format("parquet")
       .option("path", shared_uri(spark, "chunks")).option("compression", "uncompressed")
       .option("parquet.block.size", str(32 << 20))
       .bucketBy(min(shuffle_parts(spark), MAX_BUCKETS), "chunk_id").saveAsTable(name))
    return spark.table(name)


def open_output(uri: str):
    """A writable binary stream at a local or remote URI, for code in tasks."""
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))
    where.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return where.open_output_stream(path)
