"""A sharded record stream as a Spark data source.

``format("sharded_records")`` reads a stream the way a cloud stream is read: by
region and stream name, shard by shard, from a sequence number on. A stream is a
folder below ``endpoint``::

    <endpoint>/<region>/<stream name>/shard-<n>/<first sequence number>-<records>.arrow

A segment is an Arrow file of records (partitionKey, data, arrivalTimestamp) and never
changes once it is visible. Its name holds its range, so the tail of a shard is known
from the listing alone, and a range of records is read without the rest of the file.

* Offsets are ``{shard: next sequence number}``. Spark stores them in the query's
  checkpoint before a batch runs, and a batch is planned from its two offsets alone:
  a restart reads the same records again, whatever was written since, and nothing is
  lost. A shard that was not there when the query started is read from its first
  record, whatever ``startingPosition`` says (as after a split of shards).
* ``startingPosition`` is ``earliest``, ``latest`` (by sequence number: nothing written
  before the first start is read) or a JSON object ``{shard: sequence number}``, where
  other shards start at their first record. It counts at a query's first start alone.
* A shard's range is cut into input partitions of at most ``maxRecordsPerPartition``
  records, so a long backlog of one hot shard is read by many tasks.
* ``accessKey`` and ``secretKey`` go to the object store's client; they are options of the
  query alone and are never part of offsets or checkpoints. Local and HDFS
  endpoints need none.
* A record that retention removed before it was read is an error, not a silent gap;
  ``failOnDataLoss=false`` goes on at the oldest record left.

The same source reads a stream as a batch (``spark.read``), up to the tail at planning time.

``put_records`` appends the rows of a DataFrame: tasks write segments below a hidden
folder, and when all have ended the driver renames one file after another to its range.
Segments of failed or repeated tasks are never renamed, and a put that dies on the way
leaves whole segments without a gap. One put at a time may write a stream.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from postflow.session import qualified

FORMAT = "sharded_records"
SCHEMA = ("streamName string, partitionKey string, data binary, arrivalTimestamp timestamp, "
          "shardId string, sequenceNumber long")
SEGMENT = re.compile(r"(\d+)-(\d+)\.arrow")
SHARD = re.compile(r"shard-\d+")
HIDDEN = "_pending"
BATCH_ROWS = 2000
SEGMENT_ROWS = 100_000
TIME = pa.timestamp("us", tz="UTC")
RECORD = pa.schema([("partitionKey", pa.string()), ("data", pa.binary()), ("arrivalTimestamp", TIME)])


@dataclass(frozen=True)
class Segment:
    name: str
    first: int
    records: int

    @property
    def end(self) -> int:
        return self.first + self.records


class StreamStore:
    """Segments of one stream, on any file system that Arrow opens."""

    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}          # Spark gives them in lower case
        for name in ("endpoint", "region", "streamName"):
            if not options.get(name.lower()):
                raise ValueError(f"sharded_records needs the option {name}")
        self.endpoint, self.region, self.stream = (options[k].rstrip("/") for k in ("endpoint", "region", "streamname"))
        self.access, self.secret = options.get("accesskey"), options.get("secretkey")

    def open(self):
        """(file system, folder of the stream)."""
        from pyarrow import fs

        uri = self.endpoint if "://" in self.endpoint or self.endpoint.startswith("file:") else "file://" + self.endpoint
        uri = "file://" + uri.removeprefix("file:") if re.match(r"file:/[^/]", uri) else uri
        scheme, _, path = uri.partition("://")
        if scheme in ("s3", "s3a", "s3n"):
            where = fs.S3FileSystem(region=self.region, access_key=self.access, secret_key=self.secret)
        else:
            where, path = fs.FileSystem.from_uri(uri)
        return where, f"{path}/{self.region}/{self.stream}"

    def _names(self, where, folder: str) -> list[str]:
        from pyarrow import fs

        found = where.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return [f.base_name for f in found]

    def shards(self) -> list[str]:
        where, root = self.open()
        return sorted(n for n in self._names(where, root) if SHARD.fullmatch(n))

    def segments(self, shard: str) -> list[Segment]:
        """In order; a file that starts inside another one's range cannot occur."""
        where, root = self.open()
        hits = map(SEGMENT.fullmatch, self._names(where, f"{root}/{shard}"))
        return sorted((Segment(m[0], int(m[1]), int(m[2])) for m in hits if m), key=lambda s: s.first)

    def bounds(self) -> dict[str, tuple[int, int]]:
        """(oldest sequence number held, next one) of every shard."""
        out = {}
        for shard in self.shards():
            held = self.segments(shard)
            out[shard] = (held[0].first, held[-1].end) if held else (0, 0)
        return out

    def read(self, shard: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
        """Records [start, end) with their sequence numbers."""
        where, root = self.open()
        at = start
        for s in self.segments(shard):
            if s.end <= start or s.first >= end:
                continue
            if s.first > at:
                raise RuntimeError(f"records {at} to {s.first - 1} of {shard} are gone")
            with where.open_input_file(f"{root}/{shard}/{s.name}") as f:
                reader, first = pa.ipc.open_file(f), s.first
                for i in range(reader.num_record_batches):
                    if first >= end:
                        break
                    # all batches but the last hold BATCH_ROWS records: skip without reading
                    if first + BATCH_ROWS <= start and i + 1 < reader.num_record_batches:
                        first += BATCH_ROWS
                        continue
                    batch = reader.get_batch(i)
                    lo, hi = max(start - first, 0), min(end - first, batch.num_rows)
                    if lo < hi:
                        yield self._rows(batch.slice(lo, hi - lo), shard, first + lo)
                    first += batch.num_rows
            at = s.end
        if at < end:
            raise RuntimeError(f"records {at} to {end - 1} of {shard} are gone")

    def _rows(self, batch: pa.RecordBatch, shard: str, first: int) -> pa.RecordBatch:
        n = batch.num_rows
        return pa.RecordBatch.from_arrays(
            [pa.array([self.stream] * n, pa.string()), batch.column(0), batch.column(1), batch.column(2).cast(pa.timestamp("us", tz="UTC")),
             pa.array([shard] * n, pa.string()), pa.array(range(first, first + n), pa.int64())],
            names=["streamName", "partitionKey", "data", "arrivalTimestamp", "shardId", "sequenceNumber"])


class ShardRange(InputPartition):
    def __init__(self, shard: str, start: int, end: int):
        self.shard, self.start, self.end = shard, start, end


def cut_ranges(start: dict[str, int], end: dict[str, int], size: int) -> list[ShardRange]:
    """Ranges of at most ``size`` records; a shard that ``start`` does not name begins at 0."""
    return [ShardRange(shard, a, min(a + size, end[shard]))
            for shard in sorted(end) for a in range(start.get(shard, 0), end[shard], size)]


class RecordReader:
    """What the batch and the stream reader share; an instance is sent to the tasks."""

    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.store = StreamStore(options)
        self.per_partition = int(options.get("maxrecordsperpartition") or SEGMENT_ROWS)
        self.lossless = (options.get("failondataloss") or "true").lower() != "false"
        self.position = options.get("startingposition") or "earliest"
        if self.per_partition < 1:
            raise ValueError("maxRecordsPerPartition must be positive")

    def held(self, ranges: list[ShardRange]) -> list[ShardRange]:
        """``ranges`` without what retention removed, if that is allowed."""
        if self.lossless:
            return ranges
        oldest = {s: b[0] for s, b in self.store.bounds().items()}
        kept = [ShardRange(r.shard, max(r.start, oldest.get(r.shard, r.end)), r.end) for r in ranges]
        return [r for r in kept if r.start < r.end]

    def read(self, partition: ShardRange) -> Iterator[pa.RecordBatch]:
        return self.store.read(partition.shard, partition.start, partition.end)


class RecordBatchReader(RecordReader, DataSourceReader):
    def partitions(self) -> list[ShardRange]:
        bounds = self.store.bounds()
        ranges = cut_ranges({s: b[0] for s, b in bounds.items()}, {s: b[1] for s, b in bounds.items()}, self.per_partition)
        return ranges or [ShardRange("", 0, 0)]

    def read(self, partition: ShardRange) -> Iterator[pa.RecordBatch]:
        return self.store.read(partition.shard, partition.start, partition.end) if partition.shard else iter(())


class RecordStreamReader(RecordReader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        bounds = self.store.bounds()
        if self.position == "latest":
            return {s: b[1] for s, b in bounds.items()}
        first = {s: b[0] for s, b in bounds.items()}
        if self.position == "earliest":
            return first
        asked = json.loads(self.position)
        return {s: min(max(int(asked.get(s, a)), a), bounds[s][1]) for s, a in first.items()}

    def latestOffset(self) -> dict:
        return {s: b[1] for s, b in self.store.bounds().items()}

    def partitions(self, start: dict, end: dict) -> list[ShardRange]:
        return self.held(cut_ranges(start, end, self.per_partition))


class ShardedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RecordBatchReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RecordStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make ``format("sharded_records")`` known to the session; repeated calls change nothing."""
    spark.dataSource.register(ShardedRecords)


def _options(spark: SparkSession, endpoint: str, region: str, stream: str, options: dict) -> dict[str, str]:
    register(spark)
    return {"endpoint": qualified(spark, endpoint), "region": region, "streamName": stream,
            **{k: v if isinstance(v, str) else json.dumps(v) for k, v in options.items()}}


def read_records(spark: SparkSession, endpoint: str, region: str, stream: str, **options) -> DataFrame:
    """The stream as a batch, from its oldest record to its tail at planning time."""
    return spark.read.format(FORMAT).options(**_options(spark, endpoint, region, stream, options)).load()


def read_record_stream(spark: SparkSession, endpoint: str, region: str, stream: str, **options) -> DataFrame:
    """The stream as a streaming frame; options as in the module's text."""
    return spark.readStream.format(FORMAT).options(**_options(spark, endpoint, region, stream, options)).load()


class _SegmentFile:
    """A segment that a put writes as its rows come: it holds less than ``BATCH_ROWS`` records in
    memory, and all its batches but the last have ``BATCH_ROWS``."""

    def __init__(self, where, folder: str):
        where.create_dir(folder, recursive=True)
        self.name = f"{uuid.uuid4().hex}.arrow"
        self.out = where.open_output_stream(f"{folder}/{self.name}")
        self.writer = pa.ipc.new_file(self.out, RECORD)
        self.held: list[pa.RecordBatch] = []
        self.n_held = self.records = 0

    @property
    def full(self) -> bool:
        return self.records == SEGMENT_ROWS

    def add(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        """Take rows up to the segment's end; those left over."""
        room = SEGMENT_ROWS - self.records
        mine, rest = rows.slice(0, room), rows.slice(room)
        while mine.num_rows:
            part, mine = mine.slice(0, BATCH_ROWS - self.n_held), mine.slice(BATCH_ROWS - self.n_held)
            self.held.append(part)
            self.n_held += part.num_rows
            self.records += part.num_rows
            if self.n_held == BATCH_ROWS:
                self._write()
        return rest

    def _write(self) -> None:
        table = pa.Table.from_batches(self.held).combine_chunks().cast(RECORD)
        self.writer.write_table(table, max_chunksize=BATCH_ROWS)
        self.held, self.n_held = [], 0

    def close(self) -> tuple[str, int]:
        if self.held:
            self._write()
        self.writer.close()
        self.out.close()
        return self.name, self.records


def put_records(records: DataFrame, endpoint: str, region: str, stream: str, shards: int = 4,
                partition_key: Column | None = None, **options) -> dict[str, int]:
    """Append records (partitionKey, data, arrivalTimestamp) to the stream; {shard: next sequence number}.

    A record's shard is the hash of its key. Order inside a shard is the order of the
    tasks and of the rows in them.
    """
    spark = records.sparkSession
    key = partition_key if partition_key is not None else F.col("partitionKey")
    rows = records.select(key.cast("string").alias("partitionKey"), "data", F.col("arrivalTimestamp").cast("timestamp").alias("arrivalTimestamp"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("partitionKey"), F.lit(shards)).cast("int"))
    store = StreamStore(_options(spark, endpoint, region, stream, options))
    put = uuid.uuid4().hex[:16]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        where, root = store.open()
        task = TaskContext.get().partitionId()
        open_files: dict[int, _SegmentFile] = {}              # at most one for each shard
        made: list[tuple[int, int, str, int]] = []

        def close(shard: int) -> None:
            name, n = open_files.pop(shard).close()
            made.append((shard, task << 32 | len(made), name, n))

        for b in batches:
            shard = b.column(3).to_numpy()
            for s in sorted(set(shard.tolist())):
                part = b.select([0, 1, 2]).filter(pa.array(shard == s))
                while part.num_rows:
                    if s not in open_files:
                        open_files[s] = _SegmentFile(where, f"{root}/{HIDDEN}/{put}")
                    part = open_files[s].add(part)
                    if open_files[s].full:
                        close(s)
        for s in sorted(open_files):
            close(s)
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made), (pa.int32(), pa.int64(), pa.string(), pa.int64()))],
                                             names=["shard", "place", "name", "records"])

    # one row for each segment comes back, no record does; sorted here, as Spark's sort would write all segments twice
    files = sorted(rows.mapInArrow(write, "shard int, place long, name string, records long").collect(), key=lambda f: (f.shard, f.place))
    where, root = store.open()
    tail = {s: b[1] for s, b in store.bounds().items()}
    for s in range(shards):
        where.create_dir(f"{root}/shard-{s}", recursive=True)
        tail.setdefault(f"shard-{s}", 0)
    for f in files:
        shard = f"shard-{f.shard}"
        where.move(f"{root}/{HIDDEN}/{put}/{f.name}", f"{root}/{shard}/{tail[shard]:020d}-{f.records}.arrow")
        tail[shard] += f.records
    return tail


def trim_records(spark: SparkSession, endpoint: str, region: str, stream: str, before: dict[str, int], **options) -> int:
    """Retention: remove the segments that end at or before ``before[shard]``; how many were removed. The last
    segment of a shard stays, since it holds the shard's tail."""
    store = StreamStore(_options(spark, endpoint, region, stream, options))
    where, root = store.open()
    old = [f"{root}/{shard}/{s.name}" for shard, limit in before.items() for s in store.segments(shard)[:-1] if s.end <= limit]
    for path in old:
        where.delete_file(path)
    return len(old)
