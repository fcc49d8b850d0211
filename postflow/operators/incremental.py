"""Incremental cleaning: a day's feed meets an index of what is stored, not the stored rows.

Whole-record dedup over the full history reads and shuffles every column of every
record again each day. ``IncrementalFeed`` stores, beside the clean rows, an index
(key, digest) of the raw records that it has taken, where the digest is the 256-bit hash
of all their fields. A new feed

1. drops its own identical records (the day's rows are exchanged, no others),
2. anti-joins the day's (key, digest) pairs with the index, of which it reads only the
   buckets that hold the day's keys: bucket folders are pruned by their number,
3. cleans the rest, appends it, and appends their pairs to the index.

Clean rows and index pairs of a day become visible by one file, created after both are
whole, so a day that died half-way is as if it had not begun,
and a day that is run again is skipped by its name. Work grows with the day's rows
and the index of its buckets; the stored rows are never read.

Records are identical when all raw fields are (nulls alike); the hashed text is the record
as JSON, with the fields' names and nulls. One writer at a time may add days to a path.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.operators.clean import CLEANERS, drop_identical_records
from postflow.schemas import RAW
from postflow.session import _file_system

KEY = {"posts": "index", "geo": "ind", "users": "ind"}
MANIFESTS = "_days"


def record_digest(fields: list[str]) -> Column:
    """SHA-256 of a record's fields as JSON text with nulls kept (binary)."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"}), 256))


class IncrementalFeed:
    """Clean rows of ``feed`` at ``path``, grown day by day."""

    def __init__(self, spark: SparkSession, feed: str, path: str, buckets: int = 64):
        self.spark, self.feed, self.path, self.buckets = spark, feed, path.rstrip("/"), buckets
        self.fields = RAW[feed].fieldNames()

    def _fs(self):
        return _file_system(self.spark, self.path), self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def days(self) -> dict[str, str]:
        """{day: folder} of the committed days."""
        fs, at = self._fs()
        folder = at(f"{self.path}/{MANIFESTS}")
        if not fs.exists(folder):
            return {}
        names = sorted(f.getPath().getName() for f in fs.listStatus(folder))
        return {day: folder for day, folder in (json.loads(bytes.fromhex(n.removesuffix(".day"))) for n in names if n.endswith(".day"))}

    def _commit(self, day: str, folder: str) -> None:
        # the record is its own name: creating it is the commit, and there is nothing to be half written
        fs, at = self._fs()
        fs.mkdirs(at(f"{self.path}/{MANIFESTS}"))
        name = json.dumps([day, folder]).encode().hex()
        if not fs.createNewFile(at(f"{self.path}/{MANIFESTS}/{name}.day")):
            raise RuntimeError(f"{day} of {self.feed} was committed by another run")

    def read(self) -> DataFrame:
        """All clean rows."""
        folders = list(self.days().values())
        if not folders:
            return CLEANERS[self.feed](self.spark.createDataFrame([], RAW[self.feed]), dedup="none")
        return self.spark.read.parquet(*[f"{self.path}/{f}/rows" for f in folders])

    def index(self, buckets: list[int] | None = None) -> DataFrame:
        """(key, digest) of the records taken, of some buckets only if they are given."""
        folders = list(self.days().values())
        if not folders:
            return self.spark.createDataFrame([], "key string, digest binary, day string, bucket int")
        out = self.spark.read.schema("key string, digest binary, day string, bucket int").parquet(f"{self.path}/index")
        out = out.where(F.col("day").isin(folders))                     # committed days; others are pruned like buckets
        return out if buckets is None else out.where(F.col("bucket").isin(buckets))

    def add(self, day: str, raw: DataFrame) -> int:
        """Clean and store the records of ``raw`` that no earlier day has; how many there were (0 for a day that is stored)."""
        if day in self.days():
            return 0
        key = F.coalesce(F.col(KEY[self.feed]).cast("string"), F.lit(""))
        fields = [f for f in self.fields if f in raw.columns]
        new = drop_identical_records(raw.select(*fields), self.feed).withColumns(
            {"_key": key, "_digest": record_digest(fields)})
        new = new.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(self.buckets)).cast("int"))
        folder = f"day-{uuid.uuid4().hex[:16]}"
        aside = f"{self.path}/_aside/{folder}"
        new.write.partitionBy("_bucket").parquet(aside)                 # the day alone; its buckets are folders now
        day_rows = self.spark.read.schema(new.schema).parquet(aside)
        touched = sorted(r["_bucket"] for r in day_rows.select("_bucket").distinct().collect())    # ``buckets`` at most
        seen = self.index(touched).select(F.col("key").alias("_key"), F.col("digest").alias("_digest"))
        fresh = day_rows.join(seen, ["_key", "_digest"], "left_anti")
        out = f"{self.path}/{folder}"
        fresh.select(F.col("_key").alias("key"), F.col("_digest").alias("digest"), F.col("_bucket").alias("bucket")) \
            .write.partitionBy("bucket").parquet(f"{self.path}/index/day={folder}")
        CLEANERS[self.feed](fresh.select(*fields), dedup="none").write.parquet(f"{out}/rows")
        self._commit(day, folder)
        fs, at = self._fs()
        fs.delete(at(aside), True)
        return self.spark.read.parquet(f"{out}/rows").count()
