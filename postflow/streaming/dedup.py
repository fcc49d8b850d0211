"""Dedup of records with a time to live, beyond the watermark's delay.

``dedup_records`` forgets a record once the watermark passes it, so its delay must be as long as
copies may trail, and all results of later operators wait that long. Here the state of a record
lives ``ttl`` of event time whatever the delay.

A record is (partitionKey, payload), known by a SHA-256 of both. Of copies that arrive within ``ttl``
of the one kept, or before it, none passes; the first that arrives later is kept and starts a new
span. Null keys and null payloads are equal to themselves; a row without an arrival time is judged as
if it came at the start of 1970.

Records are dealt to ``buckets`` by their digest, and Python runs once per bucket and batch, on whole
arrays, not once per record. A bucket's state in RocksDB is the sorted digests of its live
records and a timestamp each, 40 bytes a record; a timer per bucket, at its earliest expiry, removes
what is over (up to a sixteenth of ``ttl`` late, so that timers do not read a bucket in every batch).
A task holds one bucket's live digests and, of its rows in the batch, those that no stored record
covers. A batch reads and writes the buckets that it touches whole: take more ``buckets`` for more
live records, and the same number as long as a checkpoint lives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TIME = "arrivalTimestamp"
DIGEST = "S32"             # all of 32 bytes, so zero bytes at an end are not lost in comparisons
BUCKETS = 1024


class _KeepFirst(StatefulProcessor):
    def __init__(self, ttl_ms: int, width: int):
        self.ttl_ms, self.width = ttl_ms, width          # width: columns of a record; its time in ms and its digest follow them

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.since = handle.getValueState("since", "digests binary, ms binary, timer long")

    def _stored(self) -> tuple[np.ndarray, np.ndarray, int | None]:
        """Sorted digests, the start of each one's span, and the bucket's timer."""
        if not self.since.exists():
            return np.empty(0, DIGEST), np.empty(0, np.int64), None
        digests, ms, timer = self.since.get()
        return np.frombuffer(digests, DIGEST), np.frombuffer(ms, np.int64), timer

    def _covered_until(self, digests: np.ndarray, ms: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """The end of the stored span of each asked digest; the least number without one."""
        until = np.full(len(asked), np.iinfo(np.int64).min)
        if len(digests):
            at = np.minimum(np.searchsorted(digests, asked), len(digests) - 1)
            hit = digests[at] == asked
            until[hit] = ms[at[hit]] + self.ttl_ms
        return until

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        digests, since, timer = self._stored()
        held, names, times = [], [], []
        for frame in rows:                               # Spark names columns by the output's schema: take them by place
            name = np.array(frame.iloc[:, self.width + 1].tolist(), DIGEST)
            ms = frame.iloc[:, self.width].to_numpy(np.int64)
            new = np.flatnonzero(ms >= self._covered_until(digests, since, name))
            if len(new):
                held.append(frame.iloc[new, :self.width])
                names.append(name[new])
                times.append(ms[new])
        if not held:
            return
        frame, name, ms = pd.concat(held), np.concatenate(names), np.concatenate(times)
        order = np.lexsort((ms, name))                   # stable: of equal times the first that came
        keep = []
        while len(order):                                # a round for each span that a record starts in this batch
            first = np.flatnonzero(np.concatenate([[True], name[order[1:]] != name[order[:-1]]]))
            size = np.diff(np.append(first, len(order)))
            kept = order[first]
            keep.append(kept)
            order = order[ms[order] >= np.repeat(ms[kept] + self.ttl_ms, size)]
        latest = np.concatenate(keep[::-1])              # np.unique takes the first of equal digests: the last span
        digests, at = np.unique(np.concatenate([name[latest], digests]), return_index=True)
        start = np.concatenate([ms[latest], since])
        self._store(digests, start[at], timer)
        yield frame.iloc[np.concatenate(keep)]

    def _store(self, digests: np.ndarray, since: np.ndarray, timer: int | None, not_before: int | None = None) -> None:
        due = int(since.min()) + self.ttl_ms
        due = due if not_before is None else max(due, not_before)
        if timer is None or due < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
            timer = due
        self.since.update((digests.tobytes(), since.tobytes(), timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        digests, since, _ = self._stored()
        now = timerValues.getCurrentWatermarkInMs()
        live = since + self.ttl_ms > now
        if live.any():
            self._store(digests[live], since[live], None, now + max(1, self.ttl_ms // 16))
        else:
            self.since.clear()
        return iter([])

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """Timers and states of this module need the RocksDB store; set before a query starts."""
    spark.conf.set(PROVIDER, ROCKSDB)


def dedup_with_ttl(records: DataFrame, ttl_seconds: int, delay: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """Records of a stream without the copies that come within ``ttl_seconds`` of one kept.

    ``delay`` bounds only how late a record may be; rows behind the watermark are dropped by Spark.
    """
    use_rocksdb(records.sparkSession)
    name = F.concat(F.coalesce(F.sha2("data", 256), F.lit("-")),
                    F.when(F.col("partitionKey").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "partitionKey")))
    keyed = (records.withWatermark(TIME, delay)
                    .withColumn("_ms", F.coalesce(F.unix_millis(TIME), F.lit(0)))
                    .withColumn("_digest", F.unhex(F.sha2(name, 256)))
                    .withColumn("_bucket", F.pmod(F.xxhash64("_digest"), F.lit(buckets)).cast("int")))
    return keyed.groupBy("_bucket").transformWithStateInPandas(
        _KeepFirst(ttl_seconds * 1000, len(records.columns)), records.schema, "Append", "EventTime")
