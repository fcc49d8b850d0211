"""Decode -> clean -> append, with Structured Streaming.

A stream source yields records with the row JSON in binary ``data``. Any
source that does (Kafka's ``value``, a cloud stream connector) plugs in through
``read_stream``'s format and options; the tests use a file stream of record
files, which replays like a stream with retained history.

Sink: ``foreachBatch`` writing each micro-batch below
``<table>/run=<run id>/batch=<epoch>`` with overwrite, or into those partitions
of a named catalog table. The run id is random and stored in the checkpoint
folder at the first start. A batch retried after a failure (same checkpoint,
same epoch) replaces its own output, so restarts do not duplicate rows, however
the checkpoint's path is spelled; a replay under a *new* checkpoint, also one
recreated at an old path, gets a new run id and appends a second copy, as a
replayed stream should. (A plain file
sink keeps its own batch log in the table folder and silently skips the
batches of a new checkpoint, new rows included.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postflow.functions.envelope import CORRUPT, decode_json, decode_json_checked, row_json
from postflow.operators.clean import CLEANERS
from postflow.schemas import STREAM
from postflow.session import drain_settings
from postflow.sources.files import first_start, read_stream
from postflow.streaming.keyed import commit_batch

RECORD_SCHEMA = T.StructType([
    T.StructField("streamName", T.StringType(), True),
    T.StructField("partitionKey", T.StringType(), True),
    T.StructField("data", T.BinaryType(), True),
    T.StructField("arrivalTimestamp", T.TimestampType(), True),
])
SINK_PARTITIONS = ("run", "batch")


def to_records(df: DataFrame, stream_name: str, partition_key: Column | None = None) -> DataFrame:
    """Rows -> stream records: row JSON (ISO timestamps, NULL fields kept) as
    binary ``data``, keyed by the first column unless ``partition_key`` is given
    (a constant key would put a whole stream on one shard)."""
    key = partition_key if partition_key is not None else F.col(df.columns[0]).cast("string")
    return df.select(F.lit(stream_name).alias("streamName"), key.alias("partitionKey"),
                     F.encode(row_json(df), "UTF-8").alias("data"),
                     F.current_timestamp().alias("arrivalTimestamp"))


def from_kafka(df: DataFrame) -> DataFrame:
    """Kafka source rows (key, value, topic, timestamp, ...) -> the pipeline's
    record columns, so every downstream step is the same as for file streams."""
    return df.select(F.col("topic").alias("streamName"),
                     F.col("key").cast("string").alias("partitionKey"),
                     F.col("value").alias("data"),
                     F.col("timestamp").alias("arrivalTimestamp"))


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
               **options) -> DataFrame:
    """Record stream from a Kafka topic (needs the Kafka connector on the
    classpath). ``starting`` is Kafka's ``startingOffsets`` (earliest/latest)."""
    df = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", topic).option("startingOffsets", starting).options(**options).load())
    return from_kafka(df)


def land_records(df: DataFrame, path: str, stream_name: str, fmt: str = "parquet",
                 partition_key: Column | None = None) -> None:
    """Append rows as record files: the test stand-in for putting them on a stream."""
    to_records(df, stream_name, partition_key).write.mode("append").format(fmt).save(path)


def decode_records(df: DataFrame, feed: str, keep: list[str] | None = None) -> DataFrame:
    """Records of ``feed`` -> the feed's payload columns (PERMISSIVE decode)."""
    return decode_json(df, STREAM[feed], "data", keep)


def dedup_records(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeated records (same key and payload) that arrive within ``delay``
    of each other. The state holds the key and a SHA-256 of the payload, not the
    payload, and is dropped once the arrival watermark passes it, so it stays
    bounded on an endless stream (``SESSION_DEFAULTS`` keep it in RocksDB)."""
    return (df.withWatermark("arrivalTimestamp", delay).withColumn("_digest", F.sha2("data", 256))
              .dropDuplicatesWithinWatermark(["partitionKey", "_digest"]).drop("_digest"))


def clean_records(df: DataFrame, feed: str) -> DataFrame:
    """Decode and clean without dedup or sort (both need state or a full view)."""
    return CLEANERS[feed](decode_records(df, feed), dedup="none")


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    new = lambda: spark.createDataFrame([(uuid.uuid4().hex[:16],)], "run string")
    return first_start(spark, checkpoint, "run", new).first().run


def _append_to_table(batch: DataFrame, name: str, run: str, epoch: int, fmt: str) -> None:
    """Overwrite the batch's own partition of catalog table ``name``; create the table at first."""
    spark = batch.sparkSession
    if not spark.catalog.tableExists(name):
        rows = batch.where("false").select("*", F.lit(run).alias("run"), F.lit(epoch).cast("long").alias("batch"))
        rows.write.format(fmt).partitionBy(*SINK_PARTITIONS).saveAsTable(name)
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type
    at = f"{root.rstrip('/')}/run={run}/batch={epoch}"
    batch.write.mode("overwrite").format(fmt).save(at)
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (run = '{run}', batch = {epoch}) LOCATION '{at}'")


def start_append(df: DataFrame, table_path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: str | None = "availableNow", query_name: str | None = None,
                 sink: str = "batches") -> StreamingQuery:
    """Start an append query of ``df`` into ``table_path`` (with ``sink="table"``:
    into the catalog table of that name).

    ``trigger``: ``"availableNow"`` (process what is there, then stop), a
    processing-time interval such as ``"10 seconds"``, or None (default
    micro-batches, run until stopped). ``sink="batches"`` is the idempotent
    per-batch writer described above, ``sink="table"`` the same writer into a
    named table, ``sink="files"`` the plain file sink, ``sink="atomic"`` the
    per-batch writer with one commit (``postflow.streaming.keyed.commit_batch``):
    a reader, a downstream stream among them, sees a batch whole or not at all.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if sink == "files":
        return writer.format(fmt).option("path", table_path).start()
    if sink not in ("batches", "table", "atomic"):
        raise ValueError(f"unknown sink {sink!r}")
    run = _run_id(df.sparkSession, checkpoint)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        if sink == "table":
            _append_to_table(batch, table_path, run, epoch, fmt)
            return
        if sink == "atomic":
            commit_batch(batch, table_path, run, epoch, fmt)
            return
        batch.write.mode("overwrite").format(fmt).save(f"{table_path}/run={run}/batch={epoch}")

    with drain_settings(df.sparkSession, trigger):
        return writer.foreachBatch(write_batch).start()


def read_appended(spark: SparkSession, table_path: str, fmt: str = "parquet") -> DataFrame:
    """Batch view of an appended table (a path, or the name of a catalog table),
    without the sink's bookkeeping columns."""
    df = spark.read.format(fmt).load(table_path) if "/" in table_path else spark.table(table_path)
    return df.drop(*[c for c in SINK_PARTITIONS if c in df.columns])


def start_quarantined(records: DataFrame, feed: str, table_path: str, quarantine_path: str,
                      checkpoint: str, trigger: str | None = "availableNow",
                      fmt: str = "parquet") -> StreamingQuery:
    """Decode with a corrupt-record column; clean and append the good records
    to ``table_path`` and keep the raw text of the bad ones (undecodable, a
    field of the wrong type, or no payload) in ``quarantine_path``. Both writes
    are per-batch overwrites, idempotent under retries."""
    decoded = decode_json_checked(records, STREAM[feed], "data",
                                  keep=["partitionKey", "arrivalTimestamp", "data"])
    bad = F.col(CORRUPT).isNotNull() | F.col("data").isNull()
    run = _run_id(records.sparkSession, checkpoint)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            good = batch.where(~bad).drop(CORRUPT, "partitionKey", "arrivalTimestamp", "data")
            CLEANERS[feed](good, dedup="none").write.mode("overwrite").format(fmt) \
                .save(f"{table_path}/run={run}/batch={epoch}")
            batch.where(bad).select("partitionKey", "arrivalTimestamp",
                                    F.col("data").cast("string").alias("payload")) \
                .write.mode("overwrite").format(fmt).save(f"{quarantine_path}/run={run}/batch={epoch}")
        finally:
            batch.unpersist()

    writer = decoded.writeStream.option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.foreachBatch(write_batch).start()


def start_feed(spark: SparkSession, feed: str, landing: str | DataFrame, table_path: str, checkpoint: str,
               starting: str = "earliest", trigger: str | None = "availableNow",
               source_fmt: str = "parquet", dedup_delay: str | None = None,
               quarantine_path: str | None = None, max_files_per_trigger: int | None = None,
               sink: str = "batches") -> StreamingQuery:
    """One feed: records -> [dedup] -> decode -> clean -> append (Parquet tables).

    ``landing`` is a folder of record files or a streaming frame of records from
    any source (``read_kafka``, ``read_stream``); ``max_files_per_trigger`` bounds
    a file stream's micro-batches, as a replay from the start needs."""
    src = landing if isinstance(landing, DataFrame) else read_stream(
        spark, landing, RECORD_SCHEMA, fmt=source_fmt, starting=starting, checkpoint=checkpoint,
        max_files_per_trigger=max_files_per_trigger)
    if dedup_delay:
        src = dedup_records(src, dedup_delay)
    if quarantine_path:
        return start_quarantined(src, feed, table_path, quarantine_path, checkpoint, trigger)
    return start_append(clean_records(src, feed), table_path, checkpoint, trigger=trigger, sink=sink)


def run_feeds(spark: SparkSession, feeds: dict[str, tuple[str | DataFrame, str, str]],
              trigger: str | None = "availableNow", dedup_delay: str | None = None,
              max_files_per_trigger: int | None = None) -> dict[str, StreamingQuery]:
    """Start independent queries, one checkpoint each: ``{feed: (landing folder or
    record stream, table, checkpoint)}``. With ``availableNow`` they are awaited here."""
    checkpoints = [c.rstrip("/").removeprefix("file:") for _, _, c in feeds.values()]
    if len(set(checkpoints)) != len(checkpoints):
        raise ValueError("every stream needs its own checkpoint")
    started = {f: start_feed(spark, f, land, table, ckpt, trigger=trigger, dedup_delay=dedup_delay,
                             max_files_per_trigger=max_files_per_trigger)
               for f, (land, table, ckpt) in feeds.items()}
    if trigger == "availableNow":
        for q in started.values():
            q.awaitTermination()
    return started


def preview(df: DataFrame, name: str) -> StreamingQuery:
    """Live preview into an in-memory table ``name`` (small test streams only:
    the memory sink keeps every row on the driver)."""
    return df.writeStream.format("memory").queryName(name).outputMode("append").start()


def compact_appended(spark: SparkSession, table_path: str, out_path: str,
                     target_file_bytes: int = 256 * 1024 * 1024) -> int:
    """Rewrite an appended table (one folder per micro-batch) into files of
    about ``target_file_bytes`` at ``out_path``; returns the file count.

    The size comes from the file listing, summed by Spark (one number reaches
    the driver); folders are merged without a shuffle. Write to a new path and swap it in when no stream is
    writing the old one; the rows are unchanged (the sink's bookkeeping
    columns are dropped)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(table_path))
    total = files.agg(F.sum("length").alias("b")).first().b or 0
    n = max(1, -(-int(total) // target_file_bytes))
    read_appended(spark, table_path).coalesce(n).write.mode("overwrite").parquet(out_path)
    return n
