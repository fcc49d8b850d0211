"""Dedup with a time to live against a plain version, over several batches and a restart."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postflow.sources.files import read_stream
from postflow.streaming.dedup import dedup_with_ttl
from postflow.streaming.pipeline import RECORD_SCHEMA, read_appended, start_append

DAY = datetime(2024, 1, 1)


def land(spark, root, rows):
    """Rows of (key, payload, minute of arrival)."""
    made = [("s", k, None if p is None else bytearray(p.encode()), DAY + timedelta(minutes=m)) for k, p, m in rows]
    spark.createDataFrame(made, "streamName string, partitionKey string, data binary, arrivalTimestamp timestamp") \
         .write.mode("append").parquet(f"{root}/in")


def drain(spark, root, ttl):
    src = read_stream(spark, f"{root}/in", RECORD_SCHEMA)
    query = start_append(dedup_with_ttl(src, ttl), f"{root}/out", f"{root}/ck")
    query.awaitTermination()
    return query


def plain(batches, ttl):
    kept, since = [], {}
    for batch in batches:
        for k, p, m in sorted(batch, key=lambda r: r[2]):
            if (k, p) not in since or m >= since[k, p] + ttl:
                since[k, p] = m
                kept.append((k, p, m))
    return sorted(kept, key=str)


def test_copies_fall_until_the_time_to_live(spark, workdir):
    batches = [
        [("a", "x", 0), ("a", "x", 0), ("a", "x", 5), ("b", "x", 1), (None, None, 2), (None, None, 3), ("a", "y", 4), ("c", "z", 0), ("c", "z", 130)],
        [("a", "x", 100), ("a", "y", 118), (None, None, 125), ("d", "w", 140)],        # beyond the watermark's delay, within two hours
        [("a", "x", 145), ("b", "x", 150), ("d", "w", 141), ("e", "v", 600)],          # the life of a and b is over
        [("e", "v", 601), ("f", "u", 900)],
    ]
    for i, batch in enumerate(batches):
        land(spark, workdir, batch)
        query = drain(spark, workdir, 120 * 60)          # a new query each time, from the checkpoint
    got = [(r.partitionKey, None if r.data is None else bytes(r.data).decode(), int((r.arrivalTimestamp - DAY).total_seconds() // 60))
           for r in read_appended(spark, f"{workdir}/out").collect()]
    assert sorted(got, key=str) == plain(batches, 120)
    land(spark, workdir, [("g", "t", 5000)])
    query = drain(spark, workdir, 120 * 60)
    state = spark.read.format("statestore").option("stateVarName", "since").load(f"{workdir}/ck")
    assert state.count() == 1                            # every expired record has left the state


def test_empty_start(spark, workdir):
    spark.createDataFrame([], RECORD_SCHEMA).write.parquet(f"{workdir}/in")
    drain(spark, workdir, 60)
    land(spark, workdir, [("a", "x", 0), ("a", "x", 0)])
    drain(spark, workdir, 60)
    assert read_appended(spark, f"{workdir}/out").count() == 1


def test_state_and_calls_go_by_bucket(spark, workdir):
    """More records than buckets, each several times and over several lives: one state row and call a bucket, not a record."""
    rnd = random.Random(4)
    keys = [(f"k{i % 1500}", f"p{i % 7}") for i in range(1500)] + [(None, "p"), ("k", None), (None, None), ("-", "-"), ("", "")]
    batches = [[(*rnd.choice(keys), rnd.randint(lo, lo + 100)) for _ in range(6000)] for lo in (0, 95, 190)]
    for batch in batches:
        land(spark, workdir, batch)
        drain(spark, workdir, 40 * 60)
    got = [(r.partitionKey, None if r.data is None else bytes(r.data).decode(), int((r.arrivalTimestamp - DAY).total_seconds() // 60))
           for r in read_appended(spark, f"{workdir}/out").collect()]
    assert sorted(got, key=str) == plain(batches, 40)
    state = spark.read.format("statestore").option("stateVarName", "since").load(f"{workdir}/ck")
    assert 0 < state.count() <= 1024 < len(keys)
