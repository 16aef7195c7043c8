"""Token counts by a two-tier lookup of pre-token lengths, without leaving the map side.

A text is the concatenation of pre-tokens (a run of spaces with the word behind
it, a word at the start of a line, or a line end), and no piece of the
vocabulary reaches over the border of two of them, so a text has as many tokens
as its pre-tokens together. Tier one is a compact table of the most frequent
pre-tokens and their lengths, broadcast to all workers; tier two is each
worker's own cache of what it has encoded, of bounded size. Pre-tokens never
cross the network: the table comes from sketches of at most ``SKETCH`` counters
for each task, which hold the counts over all documents of the pre-tokens that
are frequent anywhere. The table affects speed only.

Nulls and empty texts have no bytes and no tokens. Repeated rows are counted
again; an empty table gives no rows. A worker keeps the cache of one query, that of the last. ``n_bytes`` and ``n_tokens`` take the place of columns of these names.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import blocks, map_texts, table, text_or_empty, worker_cache

#: Counters that a task keeps of its pre-tokens, and that it hands on.
TASK_COUNTERS, SKETCH = 100_000, 4_096
#: Entries of the broadcast table: at most about 1 MB.
TABLE_ENTRIES = 32_768
#: A pre-token of the table has at most so many characters.
TABLE_CHARS = 24
#: Entries that a worker's own cache holds before it starts afresh.
CACHE_ENTRIES = 500_000

PRETOKEN = re.compile(" +[^ \n]*|[^ \n]+|\n")


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text; the library puts a space before any text that isn't empty."""
    return PRETOKEN.findall(" " + text.replace("▁", " ")) if text else []


class Lengths(dict):
    """Numbers of tokens by pre-token: starts as tier one, grows as tier two."""

    def __init__(self, model_file: str, first: dict[str, int], limit: int = CACHE_ENTRIES):
        super().__init__(first)
        import sentencepiece

        self.encode = sentencepiece.SentencePieceProcessor(model_file=model_file).encode
        self.first, self.limit = first, limit

    def __missing__(self, piece: str) -> int:
        if piece == "\n" or piece == " ":
            n = 1
        elif piece[0] == " ":
            n = len(self.encode(piece[1:]))  # the library adds the space again
        else:
            n = len(self.encode("\n" + piece)) - 2  # less the space and the line end
        self[piece] = n
        return n

    def trim(self) -> None:
        if len(self) > len(self.first) + self.limit:
            self.clear()
            self.update(self.first)


def frequent(docs: DataFrame, text: str = "text", entries: int = TABLE_ENTRIES) -> list[str]:
    """The pre-tokens that are most frequent over all documents, by mergeable sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in blocks(texts):
                for t in texts[a:b]:
                    counts.update(pretokens(t))
                if len(counts) > 3 * TASK_COUNTERS:
                    counts = Counter(dict(counts.most_common(TASK_COUNTERS)))
        top = [(p, n) for p, n in islice(counts.most_common(), SKETCH) if len(p) <= TABLE_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    sketches = docs.select(text_or_empty(text).alias("text")).mapInArrow(run, "piece string, n long")
    top = sketches.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(entries)
    return [r.piece for r in top.collect()]


def count_tokens(docs: DataFrame, model_file: str, text: str = "text", keep: list[str] | None = None, entries: int = TABLE_ENTRIES) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text."""
    run, known = uuid.uuid4().hex, Lengths(model_file, {})
    sent = docs.sparkSession.sparkContext.broadcast([(p, known[p]) for p in frequent(docs, text, entries)])

    def make():
        lengths = worker_cache("token_counts", run, lambda: Lengths(model_file, dict(sent.value)))
        of = lengths.__getitem__

        def work(texts: list[str]) -> dict[str, pa.Array]:
            n_tokens = [sum(map(of, pretokens(t))) for t in texts]
            lengths.trim()
            return {"n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64())}

        return work

    return map_texts(docs, make, [("n_bytes", T.LongType()), ("n_tokens", T.LongType())], text, keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)
