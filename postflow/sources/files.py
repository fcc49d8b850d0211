"""Batch and streaming readers.

The feed layout is ``<root>/<topic>/partition=<n>/*.json``. Reading the topic
root (not a glob below one partition) lets Spark discover every partition and
prune them; an explicit schema spares the inference scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.session import stored_whole


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               columns: list[str] | None = None, **options) -> DataFrame:
    """Batch scan of a table by path; ``fmt`` is any installed data source."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df.select(*columns) if columns else df


def read_topic(spark: SparkSession, path: str, schema: T.StructType | None = None,
               infer: bool = False, **options) -> DataFrame:
    """JSON feed scan.

    With ``schema`` the files are read in one pass and malformed records give
    NULL fields (PERMISSIVE). ``infer=True`` reproduces the inferred-schema
    load (an extra pass over all files; a ``_corrupt_record`` column appears
    when a line does not parse).
    """
    reader = spark.read.options(**options)
    if schema is not None and not infer:
        reader = reader.schema(schema)
    return reader.json(path)


def write_topic(df: DataFrame, path: str, mode: str = "append",
                partition_col: str | None = None) -> None:
    """Land rows as JSON lines, optionally below ``partition=<n>`` folders."""
    writer = df.write.mode(mode).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.json(path)


def read_stream(spark: SparkSession, path: str | None, schema: T.StructType | None, fmt: str = "parquet",
                starting: str = "earliest", max_files_per_trigger: int | None = None,
                checkpoint: str | None = None, **options) -> DataFrame:
    """Stream of envelope records (``data`` binary + key) from any source format.

    File formats take a folder and a schema; other sources (Kafka, ``rate``, a
    cloud stream) take neither, only ``options``.

    For files, ``starting="earliest"`` replays everything in the folder and an
    ISO timestamp keeps files modified after it. ``"latest"`` skips the files
    that lay there when the query first started, and only those: their list is
    stored in the ``checkpoint`` folder at the first start and read at every
    restart, so files that land while the stream is down are delivered.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path) if path else reader.load()
    if starting == "earliest":
        return df
    if path is None:
        raise ValueError("starting is for file streams; set the source's own option instead")
    if starting == "latest":
        if not checkpoint:
            raise ValueError("starting='latest' stores its cut in the stream's checkpoint folder: pass checkpoint")
        old = first_start(spark, checkpoint, "skipped-files", lambda: _files_in(spark, path))
        return (df.withColumn("_path", F.col("_metadata.file_path")).join(old, "_path", "left_anti").drop("_path"))
    return (df.withColumn("_mtime", F.col("_metadata.file_modification_time"))
              .where(F.col("_mtime") > F.lit(starting).cast("timestamp")).drop("_mtime"))


def _files_in(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path`` (its content is not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("_metadata.file_path").alias("_path"))


def first_start(spark: SparkSession, checkpoint: str, name: str, make) -> DataFrame:
    """The frame that ``make()`` gave when the stream with this checkpoint first
    started; it is stored in the checkpoint folder, so it lives and dies with it."""
    at = f"{checkpoint.rstrip('/')}/_postflow/{name}"
    if not stored_whole(spark, at):                       # the first start
        make().write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)                         # a passing read error is raised, and starts nothing anew
