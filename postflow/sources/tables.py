"""Clean tables: write the cleaned feeds once, query them many times.

Cleaning ends in a whole-row dedup, which needs every column, so a question
run on raw feeds cannot prune columns and re-shuffles all of them. Stored clean
tables fix both: a question reads only the columns it uses, and with
``buckets`` the tables are bucketed and sorted by ``ind`` through the session
catalog, so the ``ind`` joins of the questions read co-partitioned buckets and
need no exchange at all (a bucketed sort-merge join). Size ``buckets`` so that
one bucket file is a few hundred MB (about table bytes / 256 MB), the same
count for every feed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "ind"
BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(input_bytes: int) -> int:
    """Buckets of about 256 MB of raw input each."""
    return max(1, -(-input_bytes // BUCKET_BYTES))


def store_clean(frames: dict[str, DataFrame], root: str, buckets: int | None = None,
                prefix: str = "postflow") -> dict[str, str]:
    """Write each frame to a new version folder below ``root/<feed>``; return
    feed -> table name (bucketed) or path (plain Parquet).

    Tables have the fixed name ``<prefix>_<feed>``. A version is complete before
    the name is switched to it, so a reader never sees half a table, and a
    repeated run leaves no other table in the catalog. Old version folders stay
    for readers that still use them.
    """
    out = {}
    version = uuid.uuid4().hex[:8]
    for name, df in frames.items():
        path = f"{root.rstrip('/')}/{name}/v={version}"
        if buckets:
            # one task per bucket (same hash as the bucketing), so each bucket is
            # one file; without it every write task would emit a file per bucket
            spark, table, new = df.sparkSession, f"{prefix}_{name}", f"{prefix}_{name}_{version}"
            df.repartition(buckets, KEY).write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY) \
                .option("path", path).saveAsTable(new)
            spark.sql(f"DROP TABLE IF EXISTS {table}")        # external: the old version's files stay
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
            out[name] = table
        else:
            df.write.mode("overwrite").parquet(path)
            out[name] = path
    return out


def load_clean(spark: SparkSession, stored: dict[str, str]) -> dict[str, DataFrame]:
    """Open tables written by ``store_clean``."""
    return {name: spark.read.parquet(ref) if "/" in ref else spark.table(ref)
            for name, ref in stored.items()}
