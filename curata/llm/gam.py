"""Quality classifier: a generalised additive model with pairwise interactions.

The score of a text is the logistic function of a sum of table entries: one
table for each feature, indexed by the bin its value falls in, and one for each
of a few pairs of features. The tables are learned by cyclic boosting: round
after round each feature in turn gets a shallow tree over its own bins (up to
three cuts), fitted to what the model still gets wrong and added with a small
rate. Then the pairs that reduce the remaining error most get tables of their
own in the same way, with trees of one cut on each of the two features. Scoring
is a lookup and an addition for each table, over blocks of rows at once.

The model is fitted on the driver to features of at most ``TRAIN_ROWS`` labelled
rows (those with the smallest hashes), a bound that the caller may change; it is
a few kilobytes and goes to the workers with the task. Scoring covers all rows.

Nulls count as empty texts; an empty text has features and a score like others.
Repeated rows get equal scores. A document with both labels is not used, a repeated
label counts once, and a row without an id has none. ``score`` and ``predicted`` take the place of
columns of these names; an empty table gives no rows. If a label occurs for no row at all, or only one
label occurs, the score is the share of label 1 (0.5 without any row).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import column_blocks, map_texts, table, text_or_empty
from curata.llm.quality_rules import base_counts

TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 80, 40, 0.15
PREDICT_FROM = 0.3

FEATURES = ["words", "chars", "word_length", "symbols", "dup_lines", "repeats", "lines", "line_words", "digits", "upper", "stops", "other_bytes", "distinct"]


def features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` for each whole text."""
    c = {k: np.asarray(v, np.float64) for k, v in base_counts(texts).items()}
    raw = [t.encode() for t in texts]
    per = lambda x, y: x / np.maximum(y, 1)
    count = np.array([np.bincount(np.frombuffer(r, np.uint8), minlength=256) for r in raw], np.float64).reshape(len(raw), 256)
    distinct = np.array([len(set(r.split())) for r in raw], np.float64)
    words, chars = c["n_words"], c["text_chars"]
    return np.stack(
        [
            words, chars, per(c["word_chars"], words), per(c["n_symbols"], chars), per(c["n_dup_lines"], c["n_lines"]), per(c["n_repeat_words"], words), c["n_lines"], per(words, c["n_lines"]),
            per(count[:, 48:58].sum(1), chars), per(count[:, 65:91].sum(1), chars), per(count[:, [33, 46, 63]].sum(1), words), per(count[:, 128:].sum(1), chars), per(distinct, words),
        ],
        axis=1,
    )


@dataclass
class Model:
    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (cuts, values) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += values[np.searchsorted(cuts, x[:, f], "right")]
        coarse = [np.searchsorted(cuts, x[:, f], "right") for f, cuts in enumerate(self.pair_cuts)]
        for (f, g), values in zip(self.pairs, self.pair_tables, strict=True):
            z += values[coarse[f], coarse[g]]
        return 1 / (1 + np.exp(-z))


def _cuts(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """The step of a tree of so many leaves over ordered bins with gradient and hessian sums."""
    parts = [(0, len(g))]
    sums = np.r_[0, np.cumsum(g)], np.r_[0, np.cumsum(h)]

    def best(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, a
        mid = np.arange(a + 1, b)
        gl, hl, gr, hr = sums[0][mid] - sums[0][a], sums[1][mid] - sums[1][a], sums[0][b] - sums[0][mid], sums[1][b] - sums[1][mid]
        won = np.where((hl > 0.5) & (hr > 0.5), _gain(gl, hl) + _gain(gr, hr) - _gain(gl + gr, hl + hr), 0)
        i = int(np.argmax(won))
        return float(won[i]), int(mid[i])

    while len(parts) < leaves:
        won, mid, at = max((*best(*p), i) for i, p in enumerate(parts))
        if won <= 1e-9:
            break
        a, b = parts.pop(at)
        parts += [(a, mid), (mid, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best step with one cut on each axis of a grid, and its gain."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    n, m = g.shape
    i, j = np.arange(1, n)[:, None], np.arange(1, m)[None, :]
    if n < 2 or m < 2:
        return 0.0, np.zeros_like(g)
    quads = [lambda c: c[i, j], lambda c: c[i, m] - c[i, j], lambda c: c[n, j] - c[i, j], lambda c: c[n, m] - c[i, m] - c[n, j] + c[i, j]]
    won = sum(_gain(q(cg), q(ch)) for q in quads)
    a, b = np.unravel_index(int(np.argmax(won)), won.shape)
    gain = float(won[a, b] - _gain(g.sum(), h.sum()))
    out = np.zeros_like(g)
    for rows in (slice(0, a + 1), slice(a + 1, n)):
        for cols in (slice(0, b + 1), slice(b + 1, m)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
    return gain, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fits the tables by cyclic boosting."""
    if not len(y) or y.min() == y.max():
        share = 0.5 if not len(y) else float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        return Model(float(np.log(share / (1 - share))))
    base = float(np.log(y.mean() / (1 - y.mean())))
    n, k = x.shape
    cuts = [_cuts(x[:, f], BINS) for f in range(k)]
    binned = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    z = np.full(n, base)
    p = lambda: 1 / (1 + np.exp(-z))
    for _ in range(ROUNDS):
        for f in range(k):
            q = p()
            size = len(tables[f])
            step = RATE * _tree(np.bincount(binned[f], y - q, size), np.bincount(binned[f], q * (1 - q), size))
            tables[f] += step
            z += step[binned[f]]
    pair_cuts = [_cuts(x[:, f], PAIR_BINS) for f in range(k)]
    coarse = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(pair_cuts)]

    def grid(f: int, g: int) -> tuple[np.ndarray, np.ndarray]:
        q, shape = p(), (len(pair_cuts[f]) + 1, len(pair_cuts[g]) + 1)
        cell = coarse[f] * shape[1] + coarse[g]
        return np.bincount(cell, y - q, shape[0] * shape[1]).reshape(shape), np.bincount(cell, q * (1 - q), shape[0] * shape[1]).reshape(shape)

    ranked = sorted(((_pair_tree(*grid(f, g))[0], f, g) for f in range(k) for g in range(f)), reverse=True)
    pairs = [(f, g) for won, f, g in ranked[:PAIRS] if won > 0]
    pair_tables = [np.zeros((len(pair_cuts[f]) + 1, len(pair_cuts[g]) + 1)) for f, g in pairs]
    for _ in range(PAIR_ROUNDS):
        for i, (f, g) in enumerate(pairs):
            step = RATE * _pair_tree(*grid(f, g))[1]
            pair_tables[i] += step
            z += step[coarse[f], coarse[g]]
    return Model(base, cuts, tables, pairs, pair_cuts, pair_tables)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """A model of ``label`` from the labelled documents that ``labels`` lists; at most ``rows`` of them."""
    chosen = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("__id")).agg(F.min(F.col(label).cast("int")).alias("__y"), F.max(F.col(label).cast("int")).alias("__most")).where("__y = __most").drop("__most")
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    # the limit bounds this side: rows times an id and a label
    joined = docs.select(F.col(doc_id).alias("__id"), text_or_empty(text).alias("__text")).join(F.broadcast(chosen), "__id")
    width = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in column_blocks(batch.column(2)):
                x = features(batch.column(2).slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64()))], names=["id", "y", "x"])

    schema = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("y", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    got = joined.select("__id", "__y", "__text").mapInArrow(run, schema).toArrow().sort_by("id")
    # copies of a labelled row count once for each row there is
    x = np.array(got.column("x").combine_chunks().values.to_numpy()).reshape(-1, width) if got.num_rows else np.zeros((0, width))
    return fit(x, got.column("y").to_numpy().astype(np.float64))


def with_scores(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""

    def make():
        def work(texts: list[str]) -> dict[str, pa.Array]:
            s = model.score(features(texts))
            return {"score": pa.array(s), "predicted": pa.array((s >= PREDICT_FROM).astype(np.int32))}

        return work

    return map_texts(docs, make, [("score", T.DoubleType()), ("predicted", T.IntegerType())], text, keep)


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from training; a row without an id is not held out, and has no label either."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return with_scores(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")
