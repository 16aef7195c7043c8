"""SimHash near-duplicates: fingerprints, a binary trie self-join, components.

Fingerprints are computed from all word shingles of whole texts. Equal
fingerprints collapse to one node first, so groups of copies cost nothing
further. For the join, each distinct fingerprint goes to four blocks, one for
each quarter of its bits: two fingerprints that differ in three bits or fewer
agree in at least one quarter. A block that holds more than ``BLOCK_ROWS``
fingerprints is divided once more by the quarters of its other bits (the bits
that a block shares cannot differ, so a quarter of the rest agrees): such blocks
agree in 28 bits. Nothing is capped. Within a block a binary trie is joined with
itself: node pairs are traversed together from the root, the bits that differ
add up, and a pair whose sum exceeds the budget is pruned. Links are reduced to
a spanning forest of the block before they leave the task, so that a dense group
sends no more links than it has members.

Nulls and texts without words have fingerprint zero and link like any other.
Repeated rows share their fingerprint and component. A row without an id is in
no group: its component is null, and it stays. Only the id and the text are read, so
other columns may have any name; an empty table gives no rows. Rows of a hot
fingerprint (there are at most ``HOT`` of these) get their component by a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import map_texts, table, text_or_empty, written
from curata.llm.components import components

SHINGLE, SEED, BITS, MAX_DIFFERENT = 3, 42, 64, 3
#: Distinct fingerprints that a block of the join may hold before it is divided.
BLOCK_ROWS = 20_000
#: A fingerprint that more than one in so many rows has is hot.
HOT = 1_000
#: Node pairs that the traversal expands at once; bounds its memory.
FRONTIER = 200_000


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    line = b" ".join(words)
    of = xxhash.xxh64_intdigest
    if len(words) <= size:
        return of(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    n = len(first)
    h = np.fromiter((of(line[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    raw = h.astype("<u8").view(np.uint8).reshape(n, 8)
    for a in range(0, n, 4096):
        ones += np.unpackbits(raw[a : a + 4096], axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed long."""

    def make():
        def work(texts: list[str]) -> dict[str, pa.Array]:
            return {name: pa.array(np.array([fingerprint(t.encode()) for t in texts], np.uint64).view(np.int64))}

        return work

    return map_texts(docs, make, [(name, T.LongType())], text, keep)


class _Forest:
    """Union-find over rows."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def roots(self, known: np.ndarray) -> np.ndarray:
        """The root of each row, from roots known before."""
        up = np.array(self.up, np.int64)
        while not np.array_equal(up[known], known):
            known = up[known]
        return known

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def trie_links(values: np.ndarray, fixed: np.ndarray, budget: int = MAX_DIFFERENT, frontier: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``values`` (sorted, distinct unsigned numbers) at most ``budget`` bits apart.

    ``fixed`` numbers the blocks: rows of different blocks never pair. The trie
    is implicit: a node is the range of rows that share the bits so far.
    """
    edges = np.flatnonzero(np.r_[True, fixed[1:] != fixed[:-1], True])
    lo, hi = edges[:-1], edges[1:]
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    start = (lo, hi, lo, hi, np.zeros(len(lo), np.int64))
    stack = [(BITS - 1, tuple(x[a : a + frontier] for x in start)) for a in range(0, len(lo), frontier)]
    while stack:
        bit, (l1, h1, l2, h2, diff) = stack.pop()
        if not len(l1):
            continue
        if bit < 0:
            yield l1[l1 != l2], l2[l1 != l2]
            continue
        m1, m2 = _split(values, l1, h1, bit), _split(values, l2, h2, bit)
        same = l1 == l2
        parts = [
            (l1, m1, l2, m2, diff, np.ones(len(l1), bool)),  # zeros with zeros
            (m1, h1, m2, h2, diff, np.ones(len(l1), bool)),  # ones with ones
            (l1, m1, m2, h2, diff + 1, np.ones(len(l1), bool)),  # zeros with ones
            (m1, h1, l2, m2, diff + 1, ~same),  # ones with zeros: already there if both are one node
        ]
        out = []
        for a, b, c, d, e, ok in parts:
            ok = ok & (b > a) & (d > c) & (e <= budget) & ~((a == c) & (b - a == 1))
            out.append((a[ok], b[ok], c[ok], d[ok], e[ok]))
        joined = tuple(np.concatenate(x) for x in zip(*out, strict=True))
        for a in range(0, len(joined[0]), frontier):
            stack.append((bit - 1, tuple(x[a : a + frontier] for x in joined)))


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """In each range of sorted rows that share all higher bits, the first row with the bit set."""
    lo, hi = lo.copy(), hi.copy()
    shift = np.uint64(bit)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        one = (values[np.minimum(mid, len(values) - 1)] >> shift) & np.uint64(1) == 1
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)


def forest_links(values: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside the blocks: row numbers of ``values``, which need not be sorted or distinct."""
    order = np.lexsort((values, block))
    v, b = values[order], block[order]
    forest, left, right = _Forest(len(v)), [], []
    roots = np.arange(len(v))
    for x, y in trie_links(v, b):
        # links inside what is connected already go at once, whatever their number
        a, c = roots[x], roots[y]
        new = np.flatnonzero(a != c)
        if not len(new):
            continue
        pairs, first = np.unique(np.stack([np.minimum(a[new], c[new]), np.maximum(a[new], c[new])]), axis=1, return_index=True)
        for i, j, k in zip(*pairs.tolist(), new[first].tolist(), strict=True):
            if forest.join(i, j):
                left.append(int(x[k]))
                right.append(int(y[k]))
        roots = forest.roots(roots)
    return order[np.array(left, np.int64)], order[np.array(right, np.int64)]


def link_fingerprints(nodes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (``a``, ``b``) between the ``node`` ids of distinct fingerprints ``fp`` that suffice for their components."""
    parts = 4
    width = BITS // parts
    keyed = nodes.select("node", "fp", F.posexplode(F.array(*(F.shiftrightunsigned("fp", width * i).bitwiseAND((1 << width) - 1) for i in range(parts)))).alias("part", "key"))
    sizes = keyed.groupBy("part", "key").agg(F.count("*").alias("n"))
    # A block beyond block_rows: divided by quarters of its other 48 bits; blocks of one row are dropped at once.
    rest = (BITS - width) // parts
    turned = lambda part: F.shiftrightunsigned("fp", width * ((part + 1) % parts)).bitwiseOR(F.shiftleft("fp", BITS - width * ((part + 1) % parts))) if (part + 1) % parts else F.col("fp")
    other = F.lit(None).cast("long")
    for part in range(parts):
        other = F.when(F.col("part") == part, turned(part)).otherwise(other)
    sub = F.array(*(F.shiftrightunsigned(other, rest * i).bitwiseAND((1 << rest) - 1) for i in range(parts)))
    blocks = keyed.join(sizes.where("n > 1"), ["part", "key"])
    blocks = blocks.select("node", "fp", "part", "key", F.explode(F.when(F.col("n") <= block_rows, F.array(F.lit(-1).cast("long"))).otherwise(F.transform(sub, lambda x, i: i.cast("long") * (1 << rest) + x))).alias("sub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        node, fp, part, key, sub_key = (t.column(i).to_numpy() for i in range(5))
        value = fp.view(np.uint64)
        _, block = np.unique(np.stack([part.astype(np.int64) * (1 << width) + key, sub_key]), axis=1, return_inverse=True)
        a, b = forest_links(value, block.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    spread = blocks.repartition("part", "key", "sub")
    return spread.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``fp``, ``component_id``) for every row of ``docs``."""
    name = "__doc"  # whatever the column's name, it is not that of the fingerprint
    source = docs.select(F.col(f"`{doc_id}`").alias(name), text_or_empty(text).alias("__text"))
    marked = written(with_fingerprints(source, "__text", [name]), "fingerprints")
    nodes = written(marked.where(F.col(name).isNotNull()).groupBy("fp").agg(F.min(name).alias("node"), F.count("*").alias("n")), "fingerprint-nodes")
    roots = components(link_fingerprints(nodes.select("node", "fp")))
    named = nodes.join(roots, "node", "left").select("fp", "n", F.coalesce("root", "node").alias("component_id"))
    rows = marked.where(F.col(name).isNotNull())
    # fingerprints of over one in HOT rows: HOT at most, so they are broadcast and their rows stay where they are
    hot = F.broadcast(named.crossJoin(F.broadcast(nodes.agg((F.sum("n") / HOT).alias("many")))).where("n > many").select("fp", "component_id"))
    cold = rows.join(hot, "fp", "left_anti").join(named.select("fp", "component_id"), "fp", "left")
    found = rows.join(hot, "fp").unionByName(cold).unionByName(marked.where(F.col(name).isNull()).withColumn("component_id", F.lit(None).cast(docs.schema[doc_id].dataType)))
    return found.select(name, "fp", "component_id").withColumnRenamed(name, doc_id)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with the columns of ``docs``.

    Rows that share id and text are one; rows without an id stay.
    """
    firsts = near_duplicates(docs, doc_id, text).where("component_id is not null").select(F.col("component_id").alias("__first")).distinct()
    kept = docs.join(firsts, F.col(doc_id) == F.col("__first"), "left_semi")
    once = kept.withColumn("__same", F.xxhash64(F.col(f"`{text}`"))).dropDuplicates([doc_id, "__same"]).drop("__same")
    return once.unionByName(docs.where(F.col(doc_id).isNull()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
