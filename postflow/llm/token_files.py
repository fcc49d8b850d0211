"""Token ids as Arrow stream files of equal-length sequences.

Documents are sorted by id (range partitions), encoded, ended by ``end_id`` and
written as one stream of ids per file. A file is an Arrow IPC stream; each row is
one sequence:

* ``ids``   fixed-size list of ``seq_len`` unsigned integers, 16-bit if the
  vocabulary fits, else 32-bit;
* ``mask``  fixed-size list of booleans, false for the padding that follows a
  file's last token;
* ``doc_ids``, ``doc_ends``  the documents that end in this sequence and the
  position after their last id.

Buffers are uncompressed, so a memory-mapped file gives any sequence and mask
without a copy (``SequenceFile``). Files hold whole documents, at most
``file_tokens`` ids unless one document is longer. A task that runs again writes
new files; the manifest names those of the attempt that counted, and readers
take no others.

Defined results: null or empty texts hold the end id alone; null document ids
come first; rows with equal ids are ordered by a hash of their text; an empty
table writes no file.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postflow.llm import common as C
from postflow.llm.tokenizing import encoder

SEQ_LEN = 2048
FILE_TOKENS = 8 << 20
BATCH_SEQS = 512
CACHED_WORDS = 300_000        # each of two generations, about 130 MB together; a task holds little beside them
BROADCAST_FILES = 200_000      # manifest rows, about 20 MB


class _FileWriter:
    """One stream file, written batch by batch."""

    def __init__(self, uri: str, seq_len: int, width: str):
        self.uri, self.len, self.width = uri, seq_len, width
        kind = pa.uint16() if width == "<u2" else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len)),
                                 ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int32()))])
        self.out = C.open_output(uri)
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = self.base = 0
        self.docs: list[int | None] = []
        self.ends: list[int] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_tokens += len(ids)
        self.n_docs += 1
        self.docs.append(doc_id)
        self.ends.append(self.n_tokens)
        if self.n_held >= BATCH_SEQS * self.len:
            self._write(self.n_held // self.len)

    def _write(self, rows: int) -> None:
        flat = np.concatenate(self.held)
        size = rows * self.len
        valid = min(size, len(flat))
        body, rest = flat[:size], flat[size:]
        if valid < size:
            body = np.concatenate([body, np.zeros(size - valid, body.dtype)])
        ends = np.array(self.ends, np.int64)
        done = int(np.searchsorted(ends, self.base + valid, side="right"))
        local = ends[:done] - self.base - 1              # last id's position in this batch
        at = np.searchsorted(local // self.len, np.arange(rows + 1)).astype("<i4")
        cells = [pa.FixedSizeListArray.from_arrays(pa.array(body), self.len),
                 pa.FixedSizeListArray.from_arrays(pa.array(np.arange(size) < valid), self.len),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(self.docs[:done], pa.int64())),
                 pa.ListArray.from_arrays(pa.array(at), pa.array((local % self.len + 1).astype("<i4")))]
        self.stream.write_batch(pa.RecordBatch.from_arrays(cells, schema=self.schema))
        self.held, self.n_held, self.base = [rest], len(rest), self.base + valid
        self.docs, self.ends = self.docs[done:], self.ends[done:]

    def close(self) -> tuple[str, int, int]:
        if self.n_held:
            self._write(-(-self.n_held // self.len))
        self.stream.close()
        self.out.close()
        return self.uri, self.n_tokens, self.n_docs


def write_token_files(docs: DataFrame, tokenizer: str, out_uri: str, end_id: int = 2, seq_len: int = SEQ_LEN,
                      file_tokens: int = FILE_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; returns the manifest (file_no, file, n_tokens, n_docs, start),
    ``start`` being the ids in all files before it."""
    spark = docs.sparkSession
    docs = C.pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = (docs.repartitionByRange(C.shuffle_parts(spark), F.col("doc_id").asc_nulls_first())
                   .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    out_uri = out_uri.rstrip("/")

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer, CACHED_WORDS)
        width = "<u2" if max(enc.vocab_size, end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], dtype="<u4").tobytes()
        file = None
        done: list[tuple] = []
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                b = whole.slice(i, 1000)
                for doc_id, raw in zip(b.column(0).to_pylist(), enc.encode(C.texts_of(b.column(1)))):
                    if file is None:
                        file = _FileWriter(f"{out_uri}/{part:06d}-{seq:06d}-{uuid.uuid4().hex[:12]}.arrow", seq_len, width)
                    file.add(doc_id, np.frombuffer(raw + end, dtype="<u4").astype(width))
                    if file.n_tokens >= file_tokens:
                        done.append(((part << 32) | seq, *file.close()))
                        file, seq = None, seq + 1
        if file is not None:
            done.append(((part << 32) | seq, *file.close()))
        enc.trim()
        if done:
            no, uri, n_tokens, n_docs = zip(*done)
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array(no, pa.int64()), "file": pa.array([u.rsplit("/", 1)[1] for u in uri]),
                "n_tokens": pa.array(n_tokens, pa.int64()), "n_docs": pa.array(n_docs, pa.int64())})

    files = C.checkpointed(ordered.mapInArrow(run, "file_no long, file string, n_tokens long, n_docs long"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)    # one row per file
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_documents(spark: SparkSession, out_uri: str, manifest: DataFrame) -> DataFrame:
    """Documents from the files: doc_id, start (ids before it in the whole corpus),
    n_tokens, ids (binary, little-endian unsigned 32-bit)."""
    schema = "doc_id long, file string, in_file long, n_tokens long, ids binary"

    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                name, first, carry, base = path.rsplit("/", 1)[1], 0, [], 0
                with pa.ipc.open_stream(content.as_buffer()) as stream:
                    for rows in stream:
                        flat = rows.column(0).values.to_numpy()
                        size = rows.column(0).type.list_size
                        ids = rows.column(2)
                        row = np.repeat(np.arange(rows.num_rows), np.diff(ids.offsets.to_numpy()))
                        ends = row * size + rows.column(3).values.to_numpy()
                        out, at = [], 0
                        for e in ends.tolist():
                            part = [*carry, flat[at:e]]
                            out.append(np.concatenate(part).astype("<u4").tobytes())
                            carry, at = [], e
                        used = int(np.count_nonzero(rows.column(1).values.to_numpy(zero_copy_only=False)))
                        if at < used:
                            carry.append(flat[at:used].copy())
                        n = np.array([len(o) // 4 for o in out], np.int64)
                        start = first + np.concatenate([[0], np.cumsum(n)])
                        first = int(start[-1])
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(ids.values, pa.int64()), "file": pa.array([name] * len(out), pa.string()),
                            "in_file": pa.array(start[:-1], pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                            "ids": pa.array(out, pa.binary())})

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    files = spark.read.format("binaryFile").load(out_uri).select("path", "content")
    docs = files.mapInArrow(run, schema)
    known = manifest.select("file", F.col("start").alias("file_start"))
    if manifest.count() <= BROADCAST_FILES:               # one short row per file; else a shuffled join
        known = F.broadcast(known)
    return (docs.join(known, "file")                      # files of lost attempts are in no manifest
                .select("doc_id", (F.col("file_start") + F.col("in_file")).alias("start"), "n_tokens", "ids"))


class SequenceFile:
    """Zero-copy random access to one local file's sequences and masks."""

    def __init__(self, path: str):
        self._map = pa.memory_map(path)
        self.table = pa.ipc.open_stream(self._map).read_all()
        self._at = np.cumsum([0, *(len(c) for c in self.table.column("ids").chunks)])

    def __len__(self) -> int:
        return self.table.num_rows

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        k = int(np.searchsorted(self._at, i, side="right")) - 1
        j = i - int(self._at[k])
        ids, mask = self.table.column("ids").chunk(k), self.table.column("mask").chunk(k)
        n = ids.type.list_size
        return ids.values.slice((ids.offset + j) * n, n).to_numpy(), mask.values.slice((mask.offset + j) * n, n)
