"""Sinks with one commit per batch: an appended table and a keyed one.

``commit_batch`` appends: the batch is written below a hidden staging folder and
becomes visible as ``run=<run>/batch=<epoch>`` by one rename of that folder. A batch
that is repeated after its commit is skipped, one that died before it leaves only
hidden files. So a reader sees whole batches, and files never change once they
are listed: a file stream may read the table.

``KeyedTable`` holds one row per key. An upsert replaces the rows of the batch's
keys and keeps all others: keys are hashed to buckets, only the buckets a batch
touches are rewritten, and a manifest, published by one rename, names the folder of
every bucket. Readers take the newest manifest; manifests carry (run, epoch), so a
repeated batch is skipped. Rows moved by a batch grow with its buckets, not with
what the stream has ever read.

The renames are Hadoop file system calls on the driver (one a batch, no data). They are
atomic on HDFS and local disks; on an object store use its committer or a table format.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.session import _file_system

STAGING = "_staging"
MANIFESTS = "_manifests"


def _hadoop(spark: SparkSession, path: str):
    return _file_system(spark, path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path


def commit_batch(batch: DataFrame, path: str, run: str, epoch: int, fmt: str = "parquet") -> bool:
    """Append ``batch`` as one visible unit; False if this (run, epoch) was committed before."""
    spark = batch.sparkSession
    fs, at = _hadoop(spark, path)
    root = path.rstrip("/")
    target = at(f"{root}/run={run}/batch={epoch}")
    if fs.exists(target):
        return False
    staged = f"{root}/{STAGING}/{run}-{epoch}-{uuid.uuid4().hex[:12]}"
    batch.write.format(fmt).save(staged)
    fs.mkdirs(at(f"{root}/run={run}"))
    if not fs.rename(at(staged), target):
        raise RuntimeError(f"batch {epoch} of run {run} could not be committed to {path}")
    return True


def committed(spark: SparkSession, path: str, run: str, epoch: int) -> str | None:
    """The folder of a batch that ``commit_batch`` has committed."""
    fs, at = _hadoop(spark, path)
    target = f"{path.rstrip('/')}/run={run}/batch={epoch}"
    return target if fs.exists(at(target)) else None


class KeyedTable:
    """One row per key at ``path``; ``schema`` is that of the rows, ``keys`` some of its columns."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 8):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _newest(self) -> dict:
        fs, at = _hadoop(self.spark, self.path)
        folder = at(f"{self.path}/{MANIFESTS}")
        if not fs.exists(folder):
            return {"version": 0, "folders": {}, "done": {}}
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        versions = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit()]
        if not versions:
            return {"version": 0, "folders": {}, "done": {}}
        # whole text as one row: the manifest is one line
        name = f"{self.path}/{MANIFESTS}/{max(versions)}.json"
        stream = fs.open(at(name))
        try:
            raw = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(raw)

    def _publish(self, manifest: dict) -> None:
        fs, at = _hadoop(self.spark, self.path)
        temp = at(f"{self.path}/{MANIFESTS}/{uuid.uuid4().hex}.tmp")
        out = fs.create(temp, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target = at(f"{self.path}/{MANIFESTS}/{manifest['version']}.json")
        if fs.exists(target) or not fs.rename(temp, target):
            raise RuntimeError(f"another writer published version {manifest['version']} of {self.path}")

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        """The rows as of the newest manifest."""
        return self._rows(sorted(self._newest()["folders"].values()))

    def upsert(self, batch: DataFrame, run: str, epoch: int) -> bool:
        """Replace the rows of the batch's keys (one row each); False if this (run, epoch) was committed before."""
        old = self._newest()
        if old["done"].get(run, -1) >= epoch:
            return False
        rows = batch.select(*self.schema.fieldNames()).withColumn("_bucket", self._bucket()).persist()
        try:
            touched = sorted(r["_bucket"] for r in rows.select("_bucket").distinct().collect())    # at most ``buckets``
            folders = dict(old["folders"])
            if touched:
                held = self._rows([folders[str(b)] for b in touched if str(b) in folders]).alias("o")
                same = None
                for k in self.keys:
                    one = F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`"))
                    same = one if same is None else same & one
                kept = held.join(rows.select(*self.keys).alias("n"), same, "left_anti").withColumn("_bucket", self._bucket())
                version = f"{self.path}/data/{run}-{epoch}-{uuid.uuid4().hex[:12]}"
                kept.unionByName(rows).write.partitionBy("_bucket").parquet(version)
                folders |= {str(b): f"{version}/_bucket={b}" for b in touched}
            self._publish({"version": old["version"] + 1, "folders": folders, "done": old["done"] | {run: epoch}})
        finally:
            rows.unpersist()
        return True

    def vacuum(self) -> int:
        """Remove data folders that the newest manifest does not name (when no reader is using them); how many."""
        fs, at = _hadoop(self.spark, self.path)
        used = {f.rsplit("/", 2)[1] for f in self._newest()["folders"].values()}
        if not fs.exists(at(f"{self.path}/data")):
            return 0
        old = [f.getPath() for f in fs.listStatus(at(f"{self.path}/data")) if f.getPath().getName() not in used]
        for p in old:
            fs.delete(p, True)
        return len(old)
