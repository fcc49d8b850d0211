"""Removal of byte passages that repeat across documents, by two-stage suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts in a document of
smaller id goes. Strings are judged on the input and never cross documents.

1. Documents are stored once as chunks (``common.write_chunks``), so texts are
   never shuffled. Exact copies of a smaller document go whole, by a grouped
   minimum over their digests.
2. Every ``LENGTH``-byte window is keyed by the least hash of the ``GRAM``-byte
   strings in it. Equal windows have equal keys, and neighbouring windows with
   one minimum form a run, so a text gives about one key per 18 bytes. Chunks
   send their distinct keys, in sorted blocks, to hash buckets, which answer with
   the keys that occur in more than one document.
3. Only runs with such a key send their bytes, again in blocks, to the bucket of
   the key. Equal runs of a chunk are sent once; the others follow their first.
4. A bucket sorts the window suffixes of its runs in two stages: those smaller
   than their successors directly, the others by induction, scanning the buckets
   of first bytes in order. Common prefixes of neighbours of at least ``LENGTH``
   bytes delimit equal strings; those not of the least document id are removed.
5. The spans go back to the chunks, which cut them out.

The windows of a key shared by very many documents are dealt by a hash of their
own ``LENGTH`` bytes, so equal windows stay together and each part is sorted on
its own. A part that one very common window fills is sorted in bounded batches in
order of document id, with one window of each distinct string kept between them.

Defined results: null text is empty; texts under ``LENGTH`` bytes stay whole;
null ids rank after all others and equal ids never remove from each other
(repeated rows included); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import common as C

LENGTH = 50
GRAM = 16
SPAN = LENGTH - GRAM + 1           # grams in a window
BATCH = 150_000                    # windows sorted together
ALONE = 12_500                     # windows sorted together that stand alone, so that bytes are as many
BLOCK = 1 << 19                    # windows hashed together
CHUNK = 4 << 20                    # bytes of a chunk
NO_ID = np.iinfo(np.int64).max
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
LOW = np.uint64((1 << 24) - 1)


# ------------------------------------------------------------------ texts of a chunk
def texts(batch: pa.RecordBatch, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, offsets, all bytes) of a chunk."""
    ids = pc.fill_null(batch.column(id_col).cast(pa.int64()), int(NO_ID)).to_numpy(zero_copy_only=False)
    t = pc.fill_null(batch.column(text_col).cast(pa.large_string()), "").cast(pa.large_binary())
    at = np.frombuffer(t.buffers()[1], np.int64)[t.offset:t.offset + len(t) + 1]
    raw = np.frombuffer(t.buffers()[2], np.uint8) if t.buffers()[2] is not None else np.empty(0, np.uint8)
    return ids, at - at[0], raw[at[0]:at[-1]]


def runs(raw: np.ndarray, at: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, windows) of the runs of all documents but those in ``skip``."""
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    valid = np.ones(n, bool)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        valid[max(a, b - LENGTH + 1):b] = False          # windows that leave their document
    for d in skip:
        valid[at[d]:at[d + 1]] = False
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    out = []
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        m = hi - lo + SPAN - 1                           # grams of these windows
        word = np.ndarray((m + 8,), "<u8", padded.data, offset=lo, strides=(1,))
        h = word[:m] * _K[0]
        h ^= word[8:8 + m] * _K[1]
        h ^= h >> np.uint64(32)
        h *= _K[2]
        h ^= h >> np.uint64(29)
        v = (h & ~LOW) | np.arange(m, dtype=np.uint64)   # ties go to the left
        w = 1
        while 2 * w <= SPAN:
            v = np.minimum(v[:-w], v[w:])
            w *= 2
        v = np.minimum(v[:hi - lo], v[SPAN - w:SPAN - w + hi - lo])
        least = (v & LOW).astype(np.int64)
        ok = valid[lo:hi]
        new = ok.copy()
        new[1:] &= (least[1:] != least[:-1]) | ~ok[:-1]
        first = np.flatnonzero(new)
        stop = np.flatnonzero(np.r_[ok[:-1] & (~ok[1:] | new[1:]), ok[-1]]) + 1
        out.append((h[least[first]], first + lo, stop - first))
    return tuple(np.concatenate(x) for x in zip(*out))


# ------------------------------------------------------------------ two-stage suffix sort
def two_stage_order(t: np.ndarray, starts: np.ndarray, windows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Window starts in suffix order (to ``LENGTH`` bytes).

    ``t`` holds bytes + 1, each text followed by at least ``LENGTH`` zeros; text i
    is t[starts[i]:ends[i]] and its windows start at starts[i] .. + windows[i] - 1.
    """
    n = len(t)
    up = np.zeros(n, bool)                               # suffix smaller than its successor
    up[:-1] = t[:-1] < t[1:]
    differs = np.ones(n, bool)
    differs[:-1] = t[:-1] != t[1:]
    nearest = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    up = up[np.minimum(nearest, n - 1)]
    up[ends] = True                                      # a text's end is the least suffix
    next_up = np.minimum.accumulate(np.where(up, np.arange(n), n)[::-1])[::-1]
    last = next_up[starts + windows - 1]                 # induction starts at an S suffix
    size = last - starts + 1
    pos = np.repeat(starts - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    used = np.zeros(n + 1, bool)
    used[pos] = True
    induced = used[:-1] & ~up
    # stage 1: direct sort of the suffixes smaller than their successors
    direct = pos[up[pos]]
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(t, LENGTH)[direct])
    direct = direct[np.argsort(rows.view(f"S{LENGTH}").ravel(), kind="stable")]
    first_of = np.searchsorted(t[direct], np.arange(258))
    # stage 2: scan the buckets of first bytes; each suffix places its predecessor
    pending: list[list[np.ndarray]] = [[] for _ in range(257)]
    order = []

    def place(of: np.ndarray, c: int) -> np.ndarray:
        before = of - 1
        before = before[(before >= 0) & induced[before]]
        lead = t[before]
        same = before[lead == c]
        rest = lead != c
        if rest.any():
            before, lead = before[rest], lead[rest]
            by = np.argsort(lead, kind="stable")
            lead, before = lead[by], before[by]
            cut = np.flatnonzero(np.r_[True, lead[1:] != lead[:-1]])
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(lead)]):
                pending[int(lead[a])].append(before[a:b])
        return same

    for c in range(257):
        wave = np.concatenate(pending[c]) if pending[c] else np.empty(0, np.int64)
        pending[c] = []
        while len(wave):
            order.append(wave)
            wave = place(wave, c)
        mine = direct[first_of[c]:first_of[c + 1]]
        if len(mine):
            order.append(mine)
            place(mine, c)
    order = np.concatenate(order) if order else np.empty(0, np.int64)
    is_window = np.zeros(n, bool)
    inside = np.repeat(starts - np.r_[0, np.cumsum(windows)[:-1]], windows) + np.arange(windows.sum())
    is_window[inside] = True
    return order[is_window[order]]


def layout(parts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(t, starts, ends) of texts parts[at[i]:at[i+1]], each followed by LENGTH zeros."""
    size = np.diff(at)
    starts = np.r_[0, np.cumsum(size + LENGTH)[:-1]].astype(np.int64)
    t = np.zeros(int((size + LENGTH).sum()), np.uint8)
    to = np.repeat(starts - at[:-1], size) + np.arange(len(parts))
    t[to] = parts + 1                                    # UTF-8 has no byte 255
    return t, starts, starts + size


def repeated(parts: np.ndarray, at: np.ndarray, windows: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, window) pairs, as indices, whose window also starts in a text of a smaller document."""
    t, starts, ends = layout(parts, at)
    order = two_stage_order(t, starts, windows, ends)
    rows = np.lib.stride_tricks.sliding_window_view(t, LENGTH)
    new = np.ones(len(order), bool)
    for a in range(1, len(order), 1 << 16):              # common prefix with the neighbour before: LENGTH or less
        b = min(len(order), a + (1 << 16))
        new[a:b] = (rows[order[a:b]] != rows[order[a - 1:b - 1]]).any(axis=1)
    text = np.searchsorted(starts, order, side="right") - 1
    doc = docs[text]
    head = np.flatnonzero(new)
    least = np.minimum.reduceat(doc, head) if len(head) else doc
    gone = doc > np.repeat(least, np.diff(np.r_[head, len(order)]))
    return text[gone], order[gone] - starts[text[gone]]


def window_hashes(text: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Hash of the ``LENGTH`` bytes from each position of ``text``."""
    word = np.ndarray((len(text) - 7,), "<u8", np.ascontiguousarray(text).data, strides=(1,))
    h = np.zeros(len(pos), np.uint64)
    for o in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        h ^= word[pos + o]
        h *= _K[0]
        h ^= h >> np.uint64(29)
    return h * _K[1] >> np.uint64(20)


def repeated_in_hot_key(text: np.ndarray, start: np.ndarray, windows: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``repeated`` of runs text[start[i]:start[i] + windows[i] + LENGTH - 1], in ascending order of
    document, in time linear in their windows."""
    total = int(windows.sum())
    run = np.repeat(np.arange(len(windows), dtype=np.int32), windows)
    off = (np.arange(total) - np.repeat(np.r_[0, np.cumsum(windows)[:-1]], windows)).astype(np.int32)
    parts = max(1, -(-2 * total // ALONE))
    part = np.empty(total, np.int32)
    for a in range(0, total, BLOCK):
        part[a:a + BLOCK] = window_hashes(text, start[run[a:a + BLOCK]] + off[a:a + BLOCK]) % np.uint64(parts)
    order = np.argsort(part, kind="stable")              # order of document stays
    cut = np.searchsorted(part[order], np.arange(parts + 1))
    shape = np.arange(LENGTH)
    found = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        carry = order[:0]
        for k in range(a, b, ALONE):
            use = np.concatenate([carry, order[k:min(b, k + ALONE)]])
            rows = text[(start[run[use]] + off[use])[:, None] + shape]
            i, _ = repeated(rows.ravel(), np.arange(len(use) + 1) * LENGTH, np.ones(len(use), np.int64), docs[run[use]])
            new = use[i[i >= len(carry)]]                # the carried ones are firsts, never gone
            found.append((run[new].astype(np.int64), off[new].astype(np.int64)))
            if k + ALONE < b:
                left = np.ones(len(use), bool)
                left[i] = False
                left = np.flatnonzero(left)
                _, first = np.unique(rows[left].view(f"S{LENGTH}").ravel(), return_index=True)
                carry = use[left[first]]
    return tuple(np.concatenate(x) for x in zip(*found))


# ------------------------------------------------------------------ blocks between chunks and buckets
def _pack(**arrays: np.ndarray) -> bytes:
    """Named arrays, each as one cell of a compressed one-row record batch."""
    return C.pack_batch(pa.RecordBatch.from_arrays(
        [pa.array([a.tobytes()], pa.large_binary()) for a in arrays.values()],
        names=[f"{k}:{a.dtype.str}" for k, a in arrays.items()]))


def _unpack(blob) -> dict[str, np.ndarray]:
    b = C.unpack_batch(blob)
    return {k: np.frombuffer(b.column(i)[0].as_buffer(), d) for i, (k, d) in enumerate(n.split(":") for n in b.schema.names)}


def _by_bucket(key: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    b = (key >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(b, kind="stable")
    cut = np.flatnonzero(np.r_[True, b[order][1:] != b[order][:-1]]) if len(b) else np.empty(0, int)
    return [(int(b[o[0]]), o) for o in np.split(order, cut[1:])] if len(b) else []


MESSAGE = "chunk_id long, kind byte, blob binary"


def _messages(t: pa.Table, kind: int) -> list:
    return [t.column("blob")[i].as_buffer() for i in range(t.num_rows) if t.column("kind")[i].as_py() == kind]


def _copied(messages: pa.Table, n: int) -> np.ndarray:
    """Documents of a chunk that are copies of a smaller document."""
    got = [np.frombuffer(m, "<i4") for m in _messages(messages, 0)]
    return np.concatenate(got) if got else np.empty(0, np.int32)


class _Dedup:
    """The steps' task code; holds only names and sizes."""

    def __init__(self, id_col: str, text_col: str, buckets: int, whole_characters: bool):
        self.id_col, self.text_col, self.buckets, self.whole_characters = id_col, text_col, buckets, whole_characters

    def digests(self, batches):
        for rows in batches:
            for chunk, blob in zip(rows.column(0).to_pylist(), rows.column(1)):
                ids, at, raw = texts(C.unpack_batch(blob.as_buffer()), self.id_col, self.text_col)
                use = np.flatnonzero(np.diff(at) >= LENGTH)
                digest = [hashlib.blake2b(raw[at[d]:at[d + 1]], digest_size=16).digest() for d in use.tolist()]
                yield pa.RecordBatch.from_pydict({
                    "digest": pa.array(digest, pa.binary()), "doc": pa.array(ids[use], pa.int64()),
                    "chunk_id": pa.array(np.full(len(use), chunk, np.int64)), "at": pa.array(use.astype(np.int32))})

    def keys(self, chunks, messages):
        out = {"bucket": [], "chunk_id": [], "blob": []}
        for chunk, blob in zip(chunks.column("chunk_id").to_pylist(), chunks.column("docs").to_pylist()):
            ids, at, raw = texts(C.unpack_batch(blob), self.id_col, self.text_col)
            key, first, _ = runs(raw, at, _copied(messages, len(ids)))
            doc = ids[np.searchsorted(at, first, side="right") - 1]
            by = np.argsort(key, kind="stable")
            key, doc = key[by], doc[by]
            head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
            other = np.zeros(len(key), bool)
            other[1:] = (key[1:] == key[:-1]) & (doc[1:] != doc[:-1])
            many = np.add.reduceat(other.astype(np.int8), head) > 0 if len(head) else np.empty(0, bool)
            for b, o in _by_bucket(key[head], self.buckets):
                out["bucket"].append(b)
                out["chunk_id"].append(chunk)
                out["blob"].append(_pack(key=key[head][o], many=np.packbits(many[o])))
        return pa.table(out, schema=pa.schema([("bucket", pa.int32()), ("chunk_id", pa.int64()), ("blob", pa.binary())]))

    def shared_keys(self, t):
        got = [_unpack(b.as_buffer()) for b in t.column("blob")]
        key = np.concatenate([g["key"] for g in got])
        many = np.concatenate([np.unpackbits(g["many"])[:len(g["key"])] for g in got]).astype(bool)
        owner = np.repeat(np.arange(len(got)), [len(g["key"]) for g in got])
        by = np.argsort(key, kind="stable")
        k = key[by]
        twice = many[by]
        twice[1:] |= k[1:] == k[:-1]
        twice[:-1] |= k[1:] == k[:-1]
        hit = by[twice]
        out = {"chunk_id": [], "kind": [], "blob": []}
        chunk_ids = t.column("chunk_id").to_pylist()
        for i in np.unique(owner[hit]).tolist():
            out["chunk_id"].append(chunk_ids[i])
            out["kind"].append(1)
            out["blob"].append(np.sort(key[hit[owner[hit] == i]]).tobytes())
        return pa.table(out, schema=pa.schema([("chunk_id", pa.int64()), ("kind", pa.int8()), ("blob", pa.binary())]))

    def segments(self, chunks, messages):
        out = {"bucket": [], "chunk_id": [], "blob": []}
        for chunk, blob in zip(chunks.column("chunk_id").to_pylist(), chunks.column("docs").to_pylist()):
            wanted = [np.frombuffer(m, "<u8") for m in _messages(messages, 1)]
            if not wanted:
                continue
            wanted = np.sort(np.concatenate(wanted))
            ids, at, raw = texts(C.unpack_batch(blob), self.id_col, self.text_col)
            key, first, windows = runs(raw, at, _copied(messages, len(ids)))
            hit = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
            key, first, windows = key[hit], first[hit], windows[hit]
            row = np.searchsorted(at, first, side="right") - 1
            doc, size = ids[row], windows + LENGTH - 1
            by = np.lexsort((first, doc, key))           # equal runs: the least document leads
            key, first, windows, row, doc, size = (x[by] for x in (key, first, windows, row, doc, size))
            lead = self._leaders(raw, key, first, size, doc)
            for b, o in _by_bucket(key, self.buckets):
                own = lead[o] == o
                rank = np.full(len(key), -1, np.int64)
                rank[o[own]] = np.arange(int(own.sum()))
                s = size[o[own]]
                take = np.repeat(first[o[own]] - np.r_[0, np.cumsum(s)[:-1]], s) + np.arange(int(s.sum()))
                out["bucket"].append(b)
                out["chunk_id"].append(chunk)
                out["blob"].append(_pack(
                    key=key[o[own]], doc=doc[o[own]], row=row[o[own]].astype(np.int32), first=(first - at[row])[o[own]].astype(np.int64),
                    windows=windows[o[own]].astype(np.uint8), text=raw[take],
                    f_row=row[o[~own]].astype(np.int32), f_first=(first - at[row])[o[~own]].astype(np.int64),
                    f_windows=windows[o[~own]].astype(np.uint8)))
        return pa.table(out, schema=pa.schema([("bucket", pa.int32()), ("chunk_id", pa.int64()), ("blob", pa.binary())]))

    @staticmethod
    def apply(step, *tables):
        """One group's step; its memory goes back before the next one."""
        C.release_memory()
        out = step(*tables)
        C.release_memory()
        return out

    @staticmethod
    def _leaders(raw, key, first, size, doc) -> np.ndarray:
        """Per run the run that stands for it: itself, or an equal run of a smaller document."""
        n = len(key)
        lead = np.arange(n)
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if n else np.empty(0, int)
        for a, b in zip(head.tolist(), [*head[1:].tolist(), n]):
            if b - a == 1 or doc[a] == doc[b - 1]:
                continue
            seen: dict[bytes, int] = {}
            for i in range(a, b):
                text = raw[first[i]:first[i] + size[i]].tobytes()
                j = seen.setdefault(text, i)
                if doc[j] < doc[i]:
                    lead[i] = j
        return lead

    def spans(self, t):
        got = [_unpack(b.as_buffer()) for b in t.column("blob")]
        chunk = t.column("chunk_id").to_pylist()
        owner = np.repeat(np.arange(len(got)), [len(g["key"]) for g in got])
        key, doc, row, first, windows = (np.concatenate([g[c] for g in got]) for c in ("key", "doc", "row", "first", "windows"))
        windows = windows.astype(np.int64)
        text = np.concatenate([g["text"] for g in got])
        size = windows + LENGTH - 1
        start = np.r_[0, np.cumsum(size)]
        by = np.lexsort((doc, key))
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def judge(use: np.ndarray) -> None:
            s = size[use]
            at = np.r_[0, np.cumsum(s)]
            take = np.repeat(start[use] - at[:-1], s) + np.arange(int(at[-1]))
            i, w = repeated(text[take], at, windows[use], doc[use])
            found.append((use[i], w))

        head = np.flatnonzero(np.r_[True, key[by][1:] != key[by][:-1]]) if len(by) else np.empty(0, int)
        held, n = [], 0
        for a, b in zip(head.tolist(), [*head[1:].tolist(), len(by)]):
            group = by[a:b]
            total = int(windows[group].sum())
            if total > BATCH:                            # one very common key
                i, w = repeated_in_hot_key(text, start[group], windows[group], doc[group])
                found.append((group[i], w))
                continue
            held.append(group)
            n += total
            if n > BATCH:
                judge(np.concatenate(held))
                held, n = [], 0
        if held:
            judge(np.concatenate(held))
        run = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
        win = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
        out = {"chunk_id": [], "kind": [], "blob": []}
        mine = owner[run]
        order = np.argsort(mine, kind="stable")
        cut = np.searchsorted(mine[order], np.arange(len(got) + 1))
        for i, g in enumerate(got):
            o = order[cut[i]:cut[i + 1]]
            r, f = row[run[o]], first[run[o]] + win[o]
            f_size = g["f_windows"].astype(np.int64)
            r = np.r_[r, np.repeat(g["f_row"], f_size)]
            f = np.r_[f, np.repeat(g["f_first"] - np.r_[0, np.cumsum(f_size)[:-1]], f_size) + np.arange(int(f_size.sum()))] if len(f_size) else f
            if not len(r):
                continue
            o = np.lexsort((f, r))
            r, f = r[o].astype(np.int64), f[o].astype(np.int64)
            new = np.r_[True, (r[1:] != r[:-1]) | (f[1:] > f[:-1] + LENGTH)]       # touching windows are one span
            a = np.flatnonzero(new)
            out["chunk_id"].append(chunk[i])
            out["kind"].append(2)
            out["blob"].append(np.stack([r[a], f[a], f[np.r_[a[1:] - 1, len(f) - 1]] + LENGTH]).astype("<i8").tobytes())
        return pa.table(out, schema=pa.schema([("chunk_id", pa.int64()), ("kind", pa.int8()), ("blob", pa.binary())]))

    def cut(self, chunks, messages):
        tables = []
        for blob in chunks.column("docs").to_pylist():
            batch = C.unpack_batch(blob)
            ids, at, raw = texts(batch, self.id_col, self.text_col)
            edge = np.zeros(len(raw) + 1, np.int32)
            for d in _copied(messages, len(ids)).tolist():
                edge[at[d]] += 1
                edge[at[d + 1]] -= 1
            for m in _messages(messages, 2):
                r, a, b = np.frombuffer(m, "<i8").reshape(3, -1)
                np.add.at(edge, at[r] + a, 1)
                np.add.at(edge, at[r] + b, -1)
            gone = np.cumsum(edge[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = at[:-1][np.diff(at) > 0]
            begins[inner] = gone[inner]                  # a span never crosses documents
            n_gone, n_spans = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(begins)]
            n_gone, n_spans = np.diff(n_gone[at]), np.diff(n_spans[at])
            kept = np.r_[0, np.cumsum(np.diff(at) - n_gone)]
            left = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [
                None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw[~gone]))]).cast(pa.binary())
            if self.whole_characters:
                left = pa.array([b.decode("utf-8", "ignore") for b in left.to_pylist()], pa.string())
            tables.append(pa.Table.from_arrays(
                [*batch.columns, left, *(pa.array(x, pa.int64()) for x in (np.diff(at), n_gone, n_spans))],
                names=[*batch.schema.names, *self.made]))
        return pa.concat_tables(tables)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   whole_characters: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with four more columns, whose names (fresh in ``docs``) are returned by
    role: ``kept`` (binary, the remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans``.
    ``whole_characters``: ``kept`` is a string without the characters that lost a byte."""
    names = {k: C.fresh_name(docs, k) for k in ("kept", "n_bytes", "n_removed", "n_spans")}
    chunks = C.write_chunks(docs, CHUNK)
    work = _Dedup(id_col, text_col, max(64, chunks.count()), whole_characters)
    work.made = list(names.values())
    digests = C.checkpointed(chunks.mapInArrow(work.digests, "digest binary, doc long, chunk_id long, at int"))
    # checkpointed, so the join below has an exchange of its own and a hot digest is split
    least = C.checkpointed(digests.groupBy("digest").agg(F.min("doc").alias("least"), F.count("*").alias("n")).where("n > 1"))

    def packed(t):
        return pa.table({"chunk_id": t.column("chunk_id").slice(0, 1), "kind": pa.array([0], pa.int8()),
                         "blob": pa.array([t.column("at").to_numpy().astype("<i4").tobytes()], pa.binary())})

    copies = (digests.join(least, "digest").where("doc > least").select("chunk_id", "at")
                     .groupBy("chunk_id").applyInArrow(packed, MESSAGE))
    copies = C.checkpointed(copies)
    by_chunk = lambda m: chunks.groupBy("chunk_id").cogroup(m.groupBy("chunk_id"))
    block = "bucket int, chunk_id long, blob binary"
    shared = (by_chunk(copies).applyInArrow(lambda c, m: work.apply(work.keys, c, m), block)
              .groupBy("bucket").applyInArrow(lambda t: work.apply(work.shared_keys, t), MESSAGE))
    segments = by_chunk(copies.union(shared)).applyInArrow(lambda c, m: work.apply(work.segments, c, m), block)
    spans = segments.groupBy("bucket").applyInArrow(lambda t: work.apply(work.spans, t), MESSAGE)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    schema += f", `{names['kept']}` {'string' if whole_characters else 'binary'}" + "".join(f", `{names[k]}` long" for k in ("n_bytes", "n_removed", "n_spans"))
    return by_chunk(copies.union(spans)).applyInArrow(lambda c, m: work.apply(work.cut, c, m), schema), names
