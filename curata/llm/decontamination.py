"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

If a passage of a document is within k edits of a benchmark item of length m,
both share at least m - q + 1 - k*q q-grams, and the places of these in document
and item differ by about the same amount (the diagonal), which k edits can move
by k at most. So every document is slid over once: its q-grams are looked up among
the items', hits are counted in overlapping bands of diagonals of width 2k+1, and
a band that meets the bound goes to verification, a banded alignment of the item
with that region of the document. Items within the budget of edits are reported.

Characters are compared in lower case, each by itself (the final sigma is a sigma),
with any white space as a space; nothing else is normalised. A q-gram is a hash of
its code points, whatever the script. The budget is ``EDIT_RATE`` of an item's length, rounded down,
at every length; where that leaves the lemma no q-gram (short items), one of
budget + 1 pieces of the item must occur literally, and its places are verified.
Items without a letter or digit are never reported.

A text is searched in order: hits are expanded ``HITS_AT_ONCE`` at a time, and bands
that the search has passed are verified and forgotten, so memory is bounded by the
items' length, not the text's. The items are broadcast in blocks of at most
``BLOCK_CHARS`` characters, one pass over the documents for each; of several blocks
each is dropped when its pass is done, so a benchmark of any size fits. Documents
aren't shuffled. Nulls count as empty texts, which contain nothing. Repeated rows are
searched again; of equal items each is reported. Empty tables of either kind give no
hits. Only the named columns are read, and columns of other names may clash with any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import column_blocks, table, written

Q = 8
EDIT_RATE = 0.08
#: Characters of benchmark items that one broadcast holds (about 30 bytes each in a worker).
BLOCK_CHARS = 2_000_000
TABLE_BITS = 20


#: Hits (a place of a text with a place of an item) that are held at once.
HITS_AT_ONCE = 1_000_000
# Characters that count as a space, beside the space itself.
SPACES = "\n\t\r\x0b\x0c\xa0\x85\u2028\u2029\u3000"


def normal(text: str) -> str:
    """Lower case, white space to spaces, character by character (places stay)."""
    text = text.replace("İ", "i").lower()  # the one letter that would become two
    for c in SPACES[:5] if text.isascii() else SPACES:
        if c in text:
            text = text.replace(c, " ")
    return text.replace("ς", "σ")


def grams(text: str, q: int = Q) -> np.ndarray:
    """A number for each q-gram of code points of a text of q characters or more: equal q-grams have equal numbers."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    codes = codes.astype(np.uint64)
    x = codes[:n].copy()
    for j in range(1, q):  # a polynomial modulo 2**64
        x *= np.uint64(0x9E3779B97F4A7C15)
        x += codes[j : j + n]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    return x


def budget(m: int, rate: float = EDIT_RATE) -> int:
    """Edits allowed for an item of m characters."""
    return int(m * rate)


class Items:
    """An index of benchmark items."""

    def __init__(self, items: list[tuple[object, str]], rate: float = EDIT_RATE, q: int = Q):
        kept = [(i, normal(t).strip()) for i, t in items]
        kept = [(i, t) for i, t in kept if any(c.isalnum() for c in t)]
        self.q = q
        lemma = lambda t: len(t) - q + 1 - budget(len(t), rate) * q >= 1
        self.short = [(i, t, budget(len(t), rate)) for i, t in kept if not lemma(t)]
        long = [(i, t) for i, t in kept if lemma(t)]
        self.ids, self.texts = [i for i, _ in long], [t for _, t in long]
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.budgets = np.array([budget(len(t), rate) for t in self.texts], np.int64)
        self.bounds = np.array([len(t) - q + 1 - k * q for t, k in zip(self.texts, self.budgets.tolist(), strict=True)], np.int64)
        self.least = int(self.bounds.min(initial=1 << 62))
        g = [grams(t, q) for t in self.texts]
        keys = np.concatenate([np.zeros(0, np.uint64), *g])
        item = np.repeat(np.arange(len(g)), [len(x) for x in g]).astype(np.int64)
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in g)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.item, self.place = keys[order], item[order], place[order]
        self.shift = np.uint64(64 - TABLE_BITS)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.keys >> self.shift] = True

    def find(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item id, begin, end, edits) of the items that the text contains; places in characters."""
        text = normal(text)
        out = [(i, *found) for i, t, k in self.short if (found := by_pieces(t, text, k))]
        best: dict[int, tuple[int, int, int]] = {}
        if self.texts:
            for i, band in self._bands(text):
                if i in best and best[i][2] == 0:
                    continue
                w, k, t = int(self.budgets[i]) + 1, int(self.budgets[i]), self.texts[i]
                found = align(t, text, band * w, (band + 2) * w - 1, k)
                if found and (i not in best or found[2] < best[i][2]):
                    best[i] = found
        return out + [(self.ids[i], *v) for i, v in sorted(best.items())]

    def _bands(self, text: str) -> Iterator[tuple[int, int]]:
        """(item, band) of the bands of diagonals that meet the item's bound, in order of the text."""
        x = grams(text, self.q)
        at = np.flatnonzero(self.table[x >> self.shift]) if len(x) else np.zeros(0, np.int64)
        key = x[at]
        lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        some = hi > lo
        at, lo, hi = at[some], lo[some], hi[some]
        if (hi - lo).sum() < self.least:  # fewer hits than any item asks for
            return
        held = np.zeros((0, 3), np.int64)
        # so many hits at a time, or those of one place
        group = np.cumsum(hi - lo) // HITS_AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(at)] if len(at) else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            n = hi[a:b] - lo[a:b]
            where = np.repeat(at[a:b], n)
            row = np.repeat(lo[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            item, place = self.item[row], self.place[row]
            if len(cuts) == 2:  # all hits at once: items that have fewer than they ask for are done
                enough = np.bincount(item, minlength=len(self.bounds))[item] >= self.bounds[item]
                if not enough.any():
                    return
                item, place, where = item[enough], place[enough], where[enough]
            # a run of budget + 1 diagonals lies inside one of the bands [j*w, (j+2)*w)
            band = np.floor_divide(where - place, self.budgets[item] + 1)
            twice = np.concatenate
            fresh = np.stack([twice([item, item]), twice([band, band - 1]), twice([place, place])], axis=1)
            order = np.lexsort(fresh.T[::-1])
            fresh = fresh[order]
            if len(held):
                fresh = np.concatenate([held, fresh])
                fresh = fresh[np.lexsort(fresh.T[::-1])]
            held = fresh[np.r_[True, (fresh[1:] != fresh[:-1]).any(axis=1)]]  # each place of an item once
            first = np.flatnonzero(np.r_[True, (held[1:, :2] != held[:-1, :2]).any(axis=1)])
            many = np.diff(np.r_[first, len(held)])
            item, band = held[first, 0], held[first, 1]
            # a band is complete when the search is behind the item's end on its last diagonal
            width = self.budgets[item] + 1
            done = (band + 2) * width + self.lengths[item] <= at[b] if b < len(at) else np.ones(len(first), bool)
            good = done & (many >= self.bounds[item])
            yield from zip(item[good].tolist(), band[good].tolist(), strict=True)
            held = held[np.repeat(~done, many)]


def by_pieces(item: str, text: str, k: int) -> tuple[int, int, int] | None:
    """The best match of a short item: of its k + 1 pieces the edits leave one untouched."""
    at = text.find(item)
    if at >= 0 or k == 0:
        return (at, at + len(item), 0) if at >= 0 else None
    best = None
    cuts = [j * len(item) // (k + 1) for j in range(k + 2)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        at = text.find(item[a:b])
        while at >= 0:
            found = align(item, text, at - a - k, at - a + k, k)
            if found and (best is None or found[2] < best[2]):
                best = found
            at = text.find(item[a:b], at + 1)
    return best


def align(item: str, text: str, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """The best match of the whole item near the diagonals ``low``..``high`` of the text, if within ``k`` edits."""
    for d in range(max(low, 0), high + 1):  # without edits
        if text.startswith(item, d):
            return d, d + len(item), 0
    if k == 0:
        return None
    left, right = low - k, high + k  # cells off these diagonals can't be within k edits
    width = right - left + 1
    start = max(left, 0)
    codes = np.frombuffer(text[start : max(start, right + len(item))].encode("utf-32-le", "surrogatepass"), np.uint32)
    wall = np.full(width, 1 << 20, np.int64)
    cols = np.arange(width)
    at = left + cols  # place in the text before row 0
    cost = np.where((at >= 0) & (at <= len(text)), 0, wall)
    begin = at.copy()
    for j, c in enumerate(np.frombuffer(item.encode("utf-32-le", "surrogatepass"), np.uint32)):
        place = left + j + cols  # character compared on each diagonal
        inside = (place >= start) & (place < start + len(codes))
        same = np.zeros(width, bool)
        same[inside] = codes[place[inside] - start] == c
        cost1, begin1 = np.where(inside, cost + ~same, wall), begin  # match or substitution
        up, up_begin = np.r_[cost[1:], 1 << 20] + 1, np.r_[begin[1:], 0]  # item character missing in the text
        up = np.where((place + 1 >= 0) & (place + 1 <= len(text)), up, wall)
        take = up < cost1
        cost, begin = np.where(take, up, cost1), np.where(take, up_begin, begin1)
        run = np.minimum.accumulate(cost - cols)  # extra characters in the text
        source = np.maximum.accumulate(np.where(cost - cols == run, cols, 0))
        cost, begin = run + cols, begin[source]
        if cost.min() > k:
            return None
    end = int(np.argmin(cost))
    return (int(begin[end]), left + end + len(item), int(cost[end])) if cost[end] <= k else None


HITS = T.ArrayType(T.StructType([T.StructField("item", T.IntegerType()), T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("edits", T.IntegerType())]))


def item_blocks(benchmark: DataFrame, item_id: str, text: str, limit: int = BLOCK_CHARS) -> Iterator[tuple[list[tuple[object, str]], bool]]:
    """The items, a block of bounded size at a time, and whether the block is the only one; the driver holds a block and a partition."""
    block: list[tuple[object, str]] = []
    size, only = 0, True
    rows = benchmark.select(F.col(f"`{item_id}`"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).distinct().orderBy(f"`{item_id}`")
    for r in rows.toLocalIterator():
        if block and size + len(r[1]) > limit:
            only = False
            yield block, only
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1])
    yield block, only


def with_hits(docs: DataFrame, sent: Broadcast, text: str, keep: list[str], name: str = "hits", rate: float = EDIT_RATE) -> DataFrame:
    """Rows of ``docs`` that contain one of the numbered items that were sent, with the hits."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    schema = T.StructType([*fields, T.StructField(name, HITS)])
    source = docs.select(*(F.col(f"`{f.name}`") for f in fields), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    kind = pa.list_(pa.struct([("item", pa.int32()), ("begin", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(sent.value, rate)
        for batch in batches:
            column = batch.column(len(fields))
            found = [[dict(zip(("item", "begin", "end", "edits"), h, strict=True)) for h in index.find(t)] for a, b in column_blocks(column) for t in column.slice(a, b - a).to_pylist()]
            rows = pa.array([i for i, h in enumerate(found) if h], pa.int64())
            if len(rows):
                yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns[: len(fields)]), pa.array([h for h in found if h], kind)], names=[*(f.name for f in fields), name])

    return source.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE) -> DataFrame:
    """One row for each document and item found in it: ``doc_id``, ``item_id``, ``begin``, ``end`` (characters) and ``edits``."""
    spark, out = docs.sparkSession, None
    for items, only in item_blocks(benchmark, item_id, item_text):
        sent = spark.sparkContext.broadcast([(n, t) for n, (_, t) in enumerate(items)])
        hits = with_hits(docs, sent, text, [doc_id], rate=rate).select(F.col(f"`{doc_id}`"), F.explode("hits").alias("h"))
        ids = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(items)], T.StructType([T.StructField("__item", T.IntegerType()), T.StructField("item_id", benchmark.schema[item_id].dataType)]))
        part = hits.join(F.broadcast(ids), F.col("h.item") == F.col("__item")).select(F.col(f"`{doc_id}`"), "item_id", F.col("h.begin").cast("long").alias("begin"), F.col("h.end").cast("long").alias("end"), F.col("h.edits").cast("long").alias("edits"))
        if not only:
            part = written(part, "benchmark-hits")
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE) -> DataFrame:
    """The documents in which no item is found, with the columns of ``docs``."""
    mark = "__row_is_clean"
    for items, only in item_blocks(benchmark, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast([(n, t) for n, (_, t) in enumerate(items)])
        names = docs.columns
        source = docs.withColumn(mark, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, names=names) -> Iterator[pa.RecordBatch]:
            index = Items(sent.value, rate)
            for batch in batches:
                column = batch.column(len(names))
                clean = [not index.find(t) for a, b in column_blocks(column) for t in column.slice(a, b - a).to_pylist()]
                yield batch.select(names).filter(pa.array(clean, pa.bool_()))

        docs = source.mapInArrow(run, docs.schema)
        if not only:
            docs = written(docs, "clean-documents")
            sent.destroy()
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
