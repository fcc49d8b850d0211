"""Quality figures from the pass that writes a table, with no second scan.

``write_observed`` hangs named aggregates on the rows on their way to the writer
(``DataFrame.observe``); ``write_profiled`` asks for the row count and the NULLs of each
column. Each task adds its own figures once, when it succeeds, so a task that is run again
counts once. That holds while nothing shuffles between the observed rows and the writer:
observe the frame that is written. Distinct counts cannot be observed (they need a
shuffle); ``quality.key_uniqueness`` stays their query.

In a stream every batch is profiled by its own write, and the profile of each batch is
kept as a small table (``start_profiled``, ``read_profile``).

Defined results: an empty frame has 0 rows and 0 NULLs in every column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postflow.streaming.keyed import commit_batch, committed
from postflow.streaming.pipeline import _run_id, read_appended

PROFILE = "column_name string, null_count long, row_count long"


def write_observed(df: DataFrame, write: Callable[[DataFrame], object], **metrics: Column) -> dict:
    """Call ``write`` on ``df`` once and give the aggregates of the rows it wrote."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in metrics.items()]))
    return seen.get


def write_profiled(df: DataFrame, write: Callable[[DataFrame], object], columns: list[str] | None = None) -> DataFrame:
    """Call ``write`` on ``df`` and give (column_name, null_count, row_count) of what it wrote."""
    names = columns or df.columns
    nulls = {f"n{i}": F.count_if(F.col(f"`{c}`").isNull()) for i, c in enumerate(names)}
    got = write_observed(df, write, rows=F.count(F.lit(1)), **nulls)
    found = [(c, got[f"n{i}"], got["rows"]) for i, c in enumerate(names)]     # one row per column
    return df.sparkSession.createDataFrame(found, PROFILE)


def start_profiled(df: DataFrame, table_path: str, profile_path: str, checkpoint: str,
                   trigger: str | None = "availableNow") -> StreamingQuery:
    """Append a stream to ``table_path`` (one commit per batch) and each batch's profile to
    ``profile_path``. A batch that failed between both commits has its rows already; its
    profile then comes from those rows, read once more."""
    spark = df.sparkSession
    run = _run_id(spark, checkpoint)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        done = committed(spark, table_path, run, epoch)
        if done:
            rows = spark.read.schema(batch.schema).parquet(done)
            profile = write_profiled(rows, lambda d: d.write.format("noop").mode("overwrite").save())
        else:
            profile = write_profiled(batch, lambda d: commit_batch(d, table_path, run, epoch))
        commit_batch(profile.coalesce(1), profile_path, run, epoch)

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.foreachBatch(write_batch).start()


def read_profile(spark: SparkSession, profile_path: str) -> DataFrame:
    """The profile of all batches together."""
    per_batch = read_appended(spark, profile_path)
    return per_batch.groupBy("column_name").agg(F.sum("null_count").alias("null_count"), F.sum("row_count").alias("row_count"))
