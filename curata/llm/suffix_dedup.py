"""Removal of repeated substrings by suffix arrays of two-stage sorting.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with
a smaller id. A suffix array over everything would have to be one sort of all
suffixes, so the windows of ``LENGTH`` bytes are dealt into buckets first, such
that equal windows meet, and each bucket gets a suffix array of its own:

1. The anchor of a window is its least hashed run of ``ANCHOR`` bytes, so equal
   windows have equal anchors. Each task hands on the distinct anchors it holds.
   An anchor that only one document has settles its windows: nothing equals them.
2. Documents learn which of their anchors are shared (lists packed by buckets of
   documents, so a task writes one row for each bucket) and cut out their segments:
   the bytes of the neighbouring windows that have one anchor. Of the rows of a
   task that hold a segment, only those with the least document id are open: all
   windows of the others start in that document, so they go at once.
3. Each bucket concatenates its distinct segments and sorts their suffixes in two
   stages: suffixes that are smaller than their successors (by the first byte, or
   by as much as needed) directly, all others by scanning the buckets of first
   bytes in order, each suffix inducing the place of the one before it. Adjacent
   suffixes with a common prefix of ``LENGTH`` or more form runs of equal windows;
   the least document id of a run decides for all of its windows, and the open
   rows of a segment get the spans of the windows that start in a smaller one.
4. Documents unite their spans. There are as many buckets as the bytes of the texts
   ask for (``BUCKET_BYTES``).

No step brings all occurrences of a string together: a passage that is everywhere
has one row for each task in every step.

Matches never cross documents. Nulls count as empty texts, and an empty table gives
no rows. Other columns are not read. Rows that share a document id are equal in
rank: none is smaller than the other, and each keeps its own spans. A null document
id is smaller than none, and none is smaller than it: such rows stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import column_blocks, table, text_or_empty

LENGTH, ANCHOR = 50, 16
#: Anchors that a task gathers before it hands them on.
TASK_ANCHORS = 2_000_000
#: Bytes of distinct segments that a task gathers before it hands them on.
TASK_SEGMENTS = 60_000_000
#: Bytes of texts for each bucket of anchors (a bucket's segments are at most about four times as many): each bucket gets its suffix array.
BUCKET_BYTES = 2_500_000


# -- anchors ----------------------------------------------------------------
def anchors(raw: np.ndarray, length: int = LENGTH, k: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of windows with one anchor: the anchor's hash, the first and the last window of the run."""
    n = len(raw)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    eight = np.ndarray((n - 7,), "<u8", raw.tobytes(), strides=(1,))
    m = n - k + 1
    x = eight[:m] * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x += eight[k - 8 : k - 8 + m]
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    wide = length - k + 1  # anchors inside a window
    least, span = x, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        rest = wide - span
        least = np.minimum(least[:-rest], least[rest:])
    start = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    return least[start], start, np.r_[start[1:], len(least)] - 1


def block_anchors(raws: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of many texts: text number, hash, first and last window; the texts' bytes on end."""
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(raws), np.uint8)
    h, first, last = anchors(raw, length)
    # windows that reach over the end of a text don't count: cut runs at text borders
    owner = np.searchsorted(ends, first, "right")
    over = np.flatnonzero(np.searchsorted(ends, last, "right") != owner)
    if len(over):  # a run may span several texts
        parts = []
        for i in over.tolist():
            a, b = int(first[i]), int(last[i])
            while a <= b:
                o = int(np.searchsorted(ends, a, "right"))
                c = min(b, int(ends[o]) - 1)
                parts.append((i, o, a, c))
                a = c + 1
        p = np.array(parts, np.int64)
        keep = np.ones(len(h), bool)
        keep[over] = False
        h, owner = np.r_[h[keep], h[p[:, 0]]], np.r_[owner[keep], p[:, 1]]
        first, last = np.r_[first[keep], p[:, 2]], np.r_[last[keep], p[:, 3]]
        order = np.argsort(first, kind="stable")
        h, owner, first, last = h[order], owner[order], first[order], last[order]
    last = np.minimum(last, ends[owner] - length)
    good = last >= first
    return owner[good], h[good], first[good], last[good], raw


# -- suffix array -------------------------------------------------------------
def _words(raw: np.ndarray, length: int) -> list[np.ndarray]:
    """Big-endian 8-byte words from every place, at offsets that cover ``length`` bytes (zeros behind the end)."""
    padded = np.concatenate([raw, np.zeros(length + 16, np.uint8)]).tobytes()
    word = np.ndarray((len(raw) + length,), ">u8", padded, strides=(1,)).astype(np.uint64)
    return [word[o : o + len(raw)] for o in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]]


def suffix_array(raw: np.ndarray, length: int = LENGTH, words: list[np.ndarray] | None = None) -> np.ndarray:
    """The places of ``raw`` in the order of the ``length`` bytes from there (or more), by two-stage sorting."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64)
    after = np.r_[raw[1:], np.uint8(0)]
    larger = raw > after  # larger than its successor by the first byte; the last suffix counts by a zero behind it
    larger[-1] = False
    # stage one: sort the others directly, word by word, refining only what is tied
    at = np.flatnonzero(~larger)
    words = words or _words(raw, length)
    order = np.argsort(words[0][at])
    at = at[order]
    group = np.cumsum(np.r_[False, words[0][at[1:]] != words[0][at[:-1]]])
    for w in words[1:]:
        tied = np.r_[False, group[1:] == group[:-1]]
        tied[:-1] |= tied[1:].copy()
        t = np.flatnonzero(tied)
        if not len(t):
            break
        key = w[at[t]]
        # by group, then key: the key's rank is the lower half of one number
        by_key = np.argsort(key)
        rank = np.empty(len(t), np.int64)
        rank[by_key] = np.cumsum(np.r_[False, key[by_key[1:]] != key[by_key[:-1]]])
        order = np.argsort((group[t] << 32) | rank)
        at[t] = at[t[order]]
        key = key[order]
        split = np.zeros(len(at), bool)
        split[t[1:]] = (group[t[1:]] == group[t[:-1]]) & (key[1:] != key[:-1])
        group = np.cumsum(split | np.r_[False, group[1:] != group[:-1]])
    # stage two: bucket by bucket; a larger suffix follows the order of its successor, whose bucket is complete
    sorted_at = np.searchsorted(raw[at], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        done = np.concatenate([*waiting[c], at[sorted_at[c] : sorted_at[c + 1]]])
        waiting[c] = []
        if not len(done):
            continue
        out.append(done)
        before = done[done > 0] - 1
        before = before[larger[before]]
        sign = raw[before]
        order = np.argsort(sign, kind="stable")
        before, sign = before[order], sign[order]
        cut = np.flatnonzero(np.r_[True, sign[1:] != sign[:-1], True]) if len(sign) else np.zeros(0, np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            waiting[int(sign[a])].append(before[a:b])
    return np.concatenate(out)


def least_ids(segments: list[bytes], ids: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the segments, on end, the least id of a segment that has it, and where each segment begins."""
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(segments), np.uint8)
    windows = np.concatenate([[0], np.cumsum(sizes - length + 1)])
    words = _words(raw, length)
    place = suffix_array(raw, length, words)
    owner = np.repeat(np.arange(len(segments)), sizes)[place]
    inside = place + length <= ends[owner]
    place, owner = place[inside], owner[inside]
    same = np.ones(max(0, len(place) - 1), bool)  # common prefix of length or more with the next
    for w in words:
        same &= w[place[1:]] == w[place[:-1]]
    start = np.flatnonzero(np.r_[True, ~same])
    least = np.minimum.reduceat(ids[owner], start)
    out = np.empty(windows[-1], np.int64)
    out[windows[owner] + place - (ends - sizes)[owner]] = np.repeat(least, np.diff(np.r_[start, len(place)]))
    return out, windows


# -- the distributed steps ------------------------------------------------------
def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(``doc``, ``sig``, ``text``): ``sig`` tells apart rows that share an id."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), text_or_empty(text).alias("text")).select("doc", F.xxhash64("text").alias("sig"), "text")


def short(h: np.ndarray) -> np.ndarray:
    """32 bits of each anchor: enough to mark them in a document, as a mark too many costs work only."""
    return (h.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype("<u4")


def spread(doc: np.ndarray, parts: int) -> np.ndarray:
    """The bucket of each document."""
    x = doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _cuts(sorted_keys: np.ndarray) -> list[int]:
    """Where runs of equal keys begin, and the end."""
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1], True]).tolist() if len(sorted_keys) else [0]


def lists_by_bucket(h: np.ndarray, d: np.ndarray, parts: int) -> tuple[list[int], list[bytes]]:
    """Documents' anchors as bytes, one piece for each bucket of documents: pairs (document, 32 bits of the anchor)."""
    b = spread(d, parts)
    order = np.lexsort((d, b))
    h, d, b = h[order], d[order], b[order]
    cut = _cuts(b)
    return [int(b[i]) for i in cut[:-1]], [np.array([j - i], "<i8").tobytes() + d[i:j].astype("<i8").tobytes() + short(h[i:j]).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]


def anchor_rows(texts: DataFrame, parts: int, length: int = LENGTH) -> DataFrame:
    """(``h``, ``doc``, ``own``): each distinct anchor of a task with its document (null: several); and, in ``own``, lists of anchors that are shared in the task (``doc``: their bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        names = ["h", "doc", "own"]

        def out() -> Iterator[pa.RecordBatch]:
            h, d = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            held.clear()
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            new = np.r_[True, h[1:] != h[:-1]]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(h)] - 1
            many = d[first] != d[last]
            # distinct anchors, by document so that neighbouring rows look alike
            by = np.argsort(d[first], kind="stable")
            first, many1 = first[by], many[by]
            for a in range(0, len(first), 50_000):
                f = first[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(h[f].view(np.int64)), pa.array(d[f], mask=many1[a : a + 50_000]), pa.nulls(len(f), pa.binary())], names=names)
            local = many[np.cumsum(new) - 1] & np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]
            buckets, lists = lists_by_bucket(h[local], d[local], parts)
            salt = int(d[0]) & 0xFFFF  # so that lists of one bucket don't all take the same way
            yield pa.RecordBatch.from_arrays([pa.array([(b << 16) | salt for b in buckets], pa.int64()), pa.array(buckets, pa.int64()), pa.array(lists, pa.binary())], names=names)

        for batch in batches:
            ids, column = batch.column(0).to_numpy(), batch.column(1).cast(pa.binary())
            for a, b in column_blocks(column):
                owner, h, _, _, _ = block_anchors(column.slice(a, b - a).to_pylist(), length)
                if len(h):
                    held.append((h, ids[a:b][owner]))
                size += len(h)
                if size > TASK_ANCHORS:
                    yield from out()
                    size = 0
        if held:
            yield from out()

    return texts.select("doc", "text").mapInArrow(run, "h long, doc long, own binary")


def shared_anchors(rows: DataFrame, parts: int) -> DataFrame:
    """(``doc``, ``own``): for each document that has any, 32 bits of the anchors that other documents have too."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, ds = [], []
        for batch in batches:
            own = batch.column(2)
            lists = batch.filter(own.is_valid())
            if lists.num_rows:
                yield pa.RecordBatch.from_arrays([lists.column(1), lists.column(2)], names=["bucket", "own"])
            rest = batch.filter(own.is_null())
            doc = rest.column(1)
            hs.append(rest.column(0).to_numpy())
            many = doc.is_null().to_numpy(zero_copy_only=False)
            ds.append(np.rec.fromarrays([doc.fill_null(0).to_numpy(), many], names="d,many"))
        if not sum(map(len, hs)):
            return
        h, r = np.concatenate(hs), np.concatenate(ds)
        order = np.argsort(h, kind="stable")
        h, r = h[order], r[order]
        start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        low, high = np.minimum.reduceat(r["d"], start), np.maximum.reduceat(r["d"], start)
        shared = np.logical_or.reduceat(r["many"], start) | (low != high)
        count = np.diff(np.r_[start, len(h)])
        hit = np.repeat(shared & (count > 1), count) & ~r["many"]
        buckets, lists = lists_by_bucket(h[hit].view(np.uint64), r["d"][hit], parts)
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(lists, pa.binary())], names=["bucket", "own"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ds, xs = [], []
        for batch in batches:
            for raw in batch.column(1).to_pylist():
                n = int(np.frombuffer(raw, "<i8", 1)[0])
                ds.append(np.frombuffer(raw, "<i8", n, 8))
                xs.append(np.frombuffer(raw, "<u4", n, 8 + 8 * n))
        if not ds:
            return
        d, x = np.concatenate(ds), np.concatenate(xs)
        order = np.argsort(d, kind="stable")
        d, x = d[order], x[order]
        cut = _cuts(d)
        for a in range(0, len(cut) - 1, 5_000):
            c = cut[a : a + 5_001]
            yield pa.RecordBatch.from_arrays([pa.array(d[c[:-1]]), pa.array([x[i:j].tobytes() for i, j in zip(c[:-1], c[1:], strict=True)], pa.binary())], names=["doc", "own"])

    found = rows.repartition("h").mapInArrow(find, "bucket long, own binary")
    return found.repartition("bucket").mapInArrow(deal, "doc long, own binary")


def packed(texts: DataFrame) -> DataFrame:
    """(``doc``, ``sig``, ``z``): the texts' UTF-8, compressed, for the shuffle that several joins share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            column = batch.column(2).cast(pa.binary())
            for a, b in column_blocks(column):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(map(press, column.slice(a, b - a).to_pylist()), pa.binary(), size=b - a)], names=["doc", "sig", "z"])

    return texts.mapInArrow(run, "doc long, sig long, z binary")


def _unpacked(column: pa.Array) -> list[bytes]:
    open_ = zstandard.ZstdDecompressor().decompress
    return [open_(z) for z in column.to_pylist()]


def _segments(raws: list[bytes], own: list[bytes], length: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Segments of the texts' shared anchors: their bytes, anchors, texts (by number) and first bytes."""
    owner, h, first, last, raw = block_anchors(raws, length)
    begins = np.cumsum([0, *(len(r) for r in raws)])
    known = [np.frombuffer(o, "<u4") for o in own]
    # (text, anchor) pairs that are shared: both numbered and compared at once
    kt = np.repeat(np.arange(len(known)), [len(x) for x in known])
    kh = np.concatenate([np.zeros(0, "<u4"), *known])
    pair = lambda t, x: (t.astype(np.uint64) << np.uint64(32)) | (x & np.uint64(0xFFFFFFFF))
    hit = np.isin(pair(owner, h), pair(kt, kh.astype(np.uint64)))
    owner, h, first, last = owner[hit], h[hit], first[hit], last[hit]
    data = raw.tobytes()
    segments = [data[i:j] for i, j in zip(first.tolist(), (last + length).tolist(), strict=True)]
    return segments, h, owner, first - begins[owner]


def united(row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Rows (by number) that have spans, and their maximal runs as bytes: begin (upper 32 bits) and end."""
    shift = np.int64(1) << 33  # spans of different rows never touch
    order = np.lexsort((begin, row))
    base = row[order] * shift
    b, e = union(base + begin[order], base + end[order])
    at = b // shift
    spans = ((b - at * shift) << 32) | (e - at * shift)
    cut = _cuts(at)
    return at[cut[:-1]], [spans[i:j].astype("<i8").tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]


SPAN_ROWS = "doc long, sig long, spans binary"


def segment_rows(marked: DataFrame, buckets: int, length: int = LENGTH) -> DataFrame:
    """The distinct segments of a task by ``bucket`` with their open rows (``blob``), and spans of rows that are settled (``doc``, ``sig``, ``spans``)."""
    names = ["bucket", "blob", "doc", "sig", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        hashes: list[int] = []
        rows: dict[tuple[int, int], int] = {}
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            if not seen:
                return
            segments, bucket = list(seen), np.array(hashes, np.uint64)
            bucket = ((bucket >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            key = np.array(list(rows), np.int64).reshape(-1, 2)
            seg, row, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            for x in (seen, hashes, rows, parts):
                x.clear()
            doc = key[row, 0]
            least = np.full(len(segments), np.iinfo(np.int64).max)
            np.minimum.at(least, seg, doc)
            sizes = np.array([len(x) for x in segments], np.int64)
            open_ = doc == least[seg]
            settled, spans = united(row[~open_], at[~open_], (at + sizes[seg])[~open_])
            for a in range(0, len(settled), 20_000):
                k = key[settled[a : a + 20_000]]
                yield pa.RecordBatch.from_arrays([pa.array(spread(k[:, 0], 1 << 30)), pa.nulls(len(k), pa.binary()), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(spans[a : a + 20_000], pa.binary())], names=names)
            seg, row, at = seg[open_], row[open_], at[open_]
            order = np.argsort(seg, kind="stable")
            seg, row, at = seg[order], row[order], at[order]
            edge = np.searchsorted(seg, np.arange(len(segments) + 1))
            by = np.argsort(bucket, kind="stable")
            cut = _cuts(bucket[by])
            press = zstandard.ZstdCompressor(level=9).compress
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                part = by[i:j]
                group = [segments[k] for k in part.tolist()]
                count = edge[part + 1] - edge[part]
                occ = np.repeat(edge[part] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                raw = b"".join([np.array([len(group), len(occ)], "<i8").tobytes(), sizes[part].astype("<i8").tobytes(), count.astype("<i8").tobytes(), key[row[occ], 0].astype("<i8").tobytes(), key[row[occ], 1].astype("<i8").tobytes(), at[occ].astype("<i8").tobytes(), *group])
                yield pa.RecordBatch.from_arrays([pa.array([int(bucket[part[0]])], pa.int64()), pa.array([press(raw)], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())], names=names)

        for batch in batches:
            batch = batch.filter(batch.column(3).is_valid())
            for a, b in column_blocks(batch.column(2), 800_000):
                part = batch.slice(a, b - a)
                keys = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
                fresh = [i for i, k in enumerate(keys) if k not in rows]  # a repeated row has the spans of the first
                fresh = list({keys[i]: i for i in fresh}.values())
                part = part.take(pa.array(fresh, pa.int64()))
                number = np.array([rows.setdefault(keys[i], len(rows)) for i in fresh], np.int64)
                segments, h, owner, at = _segments(_unpacked(part.column(2)), part.column(3).to_pylist(), length)
                where = np.empty(len(segments), np.int64)
                for n, (s, x) in enumerate(zip(segments, h.tolist(), strict=True)):
                    k = seen.get(s)
                    if k is None:
                        seen[s] = k = len(seen)
                        hashes.append(x)
                        size += len(s) + 60
                    where[n] = k
                parts.append((where, number[owner], at))
                size += 24 * len(segments)
                if size > TASK_SEGMENTS:
                    yield from out()
                    size = 0
        yield from out()

    return marked.mapInArrow(run, "bucket long, blob binary, doc long, sig long, spans binary")


def _opened(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments, their numbers of rows, and the rows' documents, signs and first bytes."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, "<i8", 2).tolist()
    sizes, count = np.frombuffer(raw, "<i8", n, 16), np.frombuffer(raw, "<i8", n, 16 + 8 * n)
    doc, sig, at = (np.frombuffer(raw, "<i8", m, 16 + 16 * n + 8 * m * i) for i in range(3))
    ends = 16 + 16 * n + 24 * m + np.cumsum(sizes)
    return [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)], count, doc, sig, at


def bucket_spans(blobs: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of one bucket, the rows (document and sign) that lose something, and the spans they lose."""
    seen: dict[bytes, int] = {}
    segs, docs_, sigs, ats = [], [], [], []
    for blob in blobs:
        group, count, doc, sig, at = _opened(blob)
        segs.append(np.repeat(np.array([seen.setdefault(x, len(seen)) for x in group], np.int64), count))
        docs_.append(doc)
        sigs.append(sig)
        ats.append(at)
    seg, doc, sig, at = map(np.concatenate, (segs, docs_, sigs, ats))
    low = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(low, seg, doc)
    least, windows = least_ids(list(seen), low, length)
    # runs of windows with one least id, segment by segment
    edge = np.zeros(len(least), bool)
    edge[windows[:-1]] = True
    edge[1:] |= least[1:] != least[:-1]
    begin = np.flatnonzero(edge)
    end = np.r_[begin[1:], len(least)]
    first = np.searchsorted(begin, windows)  # a segment's runs
    # rows that have a run with a smaller id, against each of their segment's runs, some rows at a time
    lowest = np.minimum.reduceat(least, windows[:-1])
    open_ = np.flatnonzero(lowest[seg] < doc)
    runs = (first[1:] - first[:-1])[seg[open_]]
    rows_, begins, ends = [], [], []
    for part in np.split(open_, np.flatnonzero(np.diff(np.cumsum(runs) // 2_000_000)) + 1):
        n = first[seg[part] + 1] - first[seg[part]]
        row = np.repeat(part, n)
        run = np.repeat(first[seg[part]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        hit = least[begin[run]] < doc[row]
        row, run = row[hit], run[hit]
        rows_.append(row)
        begins.append(at[row] + begin[run] - windows[seg[row]])
        ends.append(at[row] + end[run] - windows[seg[row]] - 1 + length)
    if not rows_:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    row, begin, end = map(np.concatenate, (rows_, begins, ends))
    keys, number = np.unique(np.stack([doc[row], sig[row]], axis=1), axis=0, return_inverse=True)
    got, spans = united(number.ravel(), begin, end)
    return keys[got, 0], keys[got, 1], spans


def open_spans(segments: DataFrame, length: int = LENGTH) -> DataFrame:
    """(``doc``, ``sig``, ``spans``) of all rows: those of each bucket's segments, and those that were settled before."""
    names = ["doc", "sig", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            settled = batch.filter(batch.column(1).is_null())
            if settled.num_rows:
                yield pa.RecordBatch.from_arrays(settled.columns[2:], names=names)
            rest = batch.filter(batch.column(1).is_valid())
            for n, blob in zip(rest.column(0).to_pylist(), rest.column(1).to_pylist(), strict=True):
                held.setdefault(n, []).append(blob)
        while held:
            doc, sig, spans = bucket_spans(held.popitem()[1], length)
            for a in range(0, len(doc), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(doc[a : a + 20_000]), pa.array(sig[a : a + 20_000]), pa.array(spans[a : a + 20_000], pa.binary())], names=names)

    return segments.repartition("bucket").mapInArrow(run, SPAN_ROWS)


def union(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by spans sorted by their begin; touching spans are one run."""
    if not len(begin):
        return begin, end
    reach = np.maximum.accumulate(end)
    new = np.r_[True, begin[1:] > reach[:-1]]
    return begin[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(begin) - 1]]


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(``doc``, ``sig``, ``z``, ``pieces``): each document with an id, its text compressed, with the spans it loses (null: none), by their signs."""
    texts = _texts(docs, doc_id, text).where("doc is not null")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(parts, -(-total // BUCKET_BYTES))
    z = packed(texts)  # dealt out by document once: both joins read the same exchange
    own = shared_anchors(anchor_rows(texts, parts, length), parts)
    marked = z.join(own.hint("shuffle_hash"), "doc", "left").select("doc", "sig", "z", "own")
    spans = open_spans(segment_rows(marked, buckets, length), length)
    pieces = spans.groupBy("doc").agg(F.collect_list(F.struct("sig", "spans")).alias("pieces"))
    return z.join(pieces.hint("shuffle_hash"), "doc", "left").select("doc", "sig", "z", "pieces")


def cut(raw: bytes, pieces: bytes) -> tuple[bytes, list[tuple[int, int]]]:
    """What remains of a text, and the maximal runs that go."""
    if not pieces:
        return raw, []
    both = np.sort(np.frombuffer(pieces, "<i8"))
    begin, end = union(both >> 32, both & 0xFFFFFFFF)
    spans = list(zip(begin.tolist(), end.tolist(), strict=True))
    at, kept = 0, []
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]), spans


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, digests: bool = False) -> DataFrame:
    """Per document: ``doc_id``, the remaining bytes (``kept``) and the removed runs (``spans``), or their digests."""
    spans_type = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    full = [("kept", T.BinaryType()), ("spans", spans_type)]
    short = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(n, t) for n, t in (short if digests else full))])

    def rows(ids: pa.Array, raws: list[bytes], pieces: list[bytes]) -> pa.RecordBatch:
        done = [cut(r, p) for r, p in zip(raws, pieces, strict=True)]
        if digests:
            columns = [pa.array([len(r) for r in raws], pa.int64()), pa.array([len(r) - len(k) for r, (k, _) in zip(raws, done, strict=True)], pa.int64()), pa.array([len(s) for _, s in done], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k, _ in done], pa.string())]
        else:
            columns = [pa.array([k for k, _ in done], pa.binary()), pa.array([[{"begin": x, "end": y} for x, y in s] for _, s in done], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))]
        return pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in column_blocks(batch.column(2), 800_000):
                part = batch.slice(a, b - a)
                pieces = [b"".join(p["spans"] for p in ps or () if p["sig"] == sig) for sig, ps in zip(part.column(1).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield rows(part.column(0), _unpacked(part.column(2)), pieces)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2).cast(pa.binary())
            for a, b in column_blocks(column):
                yield rows(batch.column(0).slice(a, b - a), column.slice(a, b - a).to_pylist(), [b""] * (b - a))

    unnamed = _texts(docs.where(F.col(f"`{doc_id}`").isNull()), doc_id, text).mapInArrow(whole, schema)
    return with_spans(docs, doc_id, text, length).mapInArrow(run, schema).unionByName(unnamed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digests=True)
