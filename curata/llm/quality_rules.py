"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each text gets base counts (words, characters in words, symbols, repeated lines
and words). From them come four rates: symbols per character, share of repeated
lines, share of repeated words, and mean word length. For each language and
source, quantile sketches of the rates (partial sketches per task, merged in the
shuffle, so a hot source costs no more than any other) give the quartiles; a
document whose rate lies beyond the quartile by more than ``FENCE`` times the
distance of the quartiles plus a small slack breaks the rule. A group's quartiles are
means, weighed by documents, of its own and, as if ``LEAST`` documents had them, its
language's, and a language's of its own and the whole table's: the fewer documents a
group has, the nearer it is to the next coarser one. Fixed cutoffs exist only for the base
rule (too few words, or half of the words in repeated windows).

Nulls count as empty texts (which fail the base rule); a null language or source
is a group of its own. Repeated rows are judged alike and each is kept. Columns of
the input pass through; a new one takes the place of one of its name. An empty
table has no thresholds and no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import map_texts, table, written

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
FENCE = 4.0
LEAST = 100
ACCURACY = 10_000
#: Rates, whether a low one breaks the rule too, and what a rate may always differ from the quartile.
RATES = {"symbol_rate": (False, 0.02), "dup_line_rate": (False, 0.5), "repeat_rate": (False, 0.25), "word_length": (True, 1.5)}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "text_chars"]


class _Index(dict):
    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def base_counts(texts: list[str]) -> dict[str, list[int] | np.ndarray]:
    """The base counts of whole texts."""
    out: dict[str, list[int] | np.ndarray] = {k: [] for k in COUNTS}
    index = _Index()
    words: list[bytes] = []
    for t in texts:
        w = t.encode().split()  # bytes split at the six ASCII white-space characters
        words += w
        out["n_words"].append(len(w))
        out["word_chars"].append(len(t) - sum(map(t.count, SPACES)))
        out["n_symbols"].append(sum(map(t.count, SYMBOLS)))
        lines = [x for x in t.split("\n") if x.strip(SPACES)]
        out["n_lines"].append(len(lines))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["text_chars"].append(len(t))
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(texts)), out["n_words"])
    out["n_repeat_words"] = _repeated(ids, owner, len(index), len(texts))
    return out


def _repeated(ids: np.ndarray, owner: np.ndarray, kinds: int, texts: int) -> np.ndarray:
    """Words inside a window of three that its text holds twice or more."""
    if len(ids) < 3:
        return np.zeros(texts, np.int64)
    inside = np.flatnonzero(owner[2:] == owner[:-2])
    pair = ids[:-1] * kinds + ids[1:]
    if kinds < 2_000_000:
        key = pair[inside] * kinds + ids[inside + 2]
    else:  # three ids don't fit in 63 bits: number the pairs first
        key = np.unique(pair, return_inverse=True)[1][inside] * kinds + ids[inside + 2]
    order = np.argsort(key, kind="stable")  # stable: texts stay together within a key
    k, o = key[order], owner[inside[order]]
    same = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    twice = inside[order[np.r_[same, False] | np.r_[False, same]]]
    covered = np.zeros(len(ids), bool)
    for d in range(3):
        covered[twice + d] = True
    return np.bincount(owner[covered], minlength=texts)


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """``docs`` with the base counts of each whole text, their names after ``prefix``."""

    def make():
        def work(texts: list[str]) -> dict[str, pa.Array]:
            return {prefix + k: pa.array(v, pa.int64()) for k, v in base_counts(texts).items()}

        return work

    return map_texts(docs, make, [(prefix + k, T.LongType()) for k in COUNTS], text, keep)


def rates(prefix: str = "") -> dict[str, Column]:
    c = {k: F.col(prefix + k).cast("double") for k in COUNTS}
    least = lambda x: F.greatest(x, F.lit(1.0))
    return {
        "symbol_rate": c["n_symbols"] / least(c["text_chars"]),
        "dup_line_rate": c["n_dup_lines"] / least(c["n_lines"]),
        "repeat_rate": c["n_repeat_words"] / least(c["n_words"]),
        "word_length": c["word_chars"] / least(c["n_words"]),
    }


def base_failed(prefix: str = "") -> Column:
    words, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > 50 * words)


def thresholds(counted: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "", fence: float = FENCE, least: int = LEAST) -> DataFrame:
    """One row per language and source: ``_lang``, ``_source`` and the bounds of each rate.

    Only documents that pass the base rule count. All grains are aggregated from the
    counts, a few numbers a document; the texts are not read again.
    """
    passing = counted.where(~base_failed(prefix))
    keyed = passing.select(F.col(lang).cast("string").alias("_lang"), F.col(source).cast("string").alias("_source"), *(c.alias(k) for k, c in rates(prefix).items()))
    quartiles = [F.percentile_approx(k, F.array(F.lit(0.25), F.lit(0.75)), ACCURACY) for k in RATES]

    def grain(by: list[str], tag: str) -> DataFrame:
        made = keyed.groupBy(*by).agg(F.count("*").alias(f"_n{tag}"), *(q.alias(f"{k}{tag}") for k, q in zip(RATES, quartiles, strict=True)))
        return made.select(*(F.col(c).alias(f"{c}{tag}") for c in by), *(c for c in made.columns if c not in by))

    every = counted.select(F.col(lang).cast("string").alias("_lang"), F.col(source).cast("string").alias("_source")).distinct()
    joined = every.join(grain(["_lang", "_source"], "0"), F.col("_lang").eqNullSafe(F.col("_lang0")) & F.col("_source").eqNullSafe(F.col("_source0")), "left")
    joined = joined.join(grain(["_lang"], "1"), F.col("_lang").eqNullSafe(F.col("_lang1")), "left").join(F.broadcast(grain([], "2")), F.lit(True), "left")

    def quartile(k: str, i: int) -> Column:
        """That of the group, drawn to its language's by ``least`` documents, which is drawn to the whole table's likewise."""
        value = F.get(F.col(f"{k}2"), i)
        for tag in ("1", "0"):
            n = F.coalesce(F.col(f"_n{tag}"), F.lit(0)).cast("double")
            value = (n * F.coalesce(F.get(F.col(f"{k}{tag}"), i), F.lit(0.0)) + F.lit(float(least)) * value) / (n + F.lit(float(least)))
        return value

    bounds = []
    for k, (both, slack) in RATES.items():
        low, high = quartile(k, 0), quartile(k, 1)
        reach = F.lit(fence) * (high - low) + F.lit(slack)
        bounds.append((high + reach).alias(f"{k}_max"))
        if both:
            bounds.append((low - reach).alias(f"{k}_min"))
    return joined.select("_lang", "_source", *bounds)


def judge(counted: DataFrame, limits: DataFrame, verdict: str = "kept", lang: str = "lang", source: str = "source", prefix: str = "") -> DataFrame:
    """``counted`` with a boolean ``verdict``: passes the base rule and every adaptive threshold.

    The thresholds are one row per language and source and joined by these; the
    optimizer broadcasts them if their size allows and otherwise splits hot keys.
    """
    limits = limits.select(*(F.col(c).alias(f"__t_{c}") for c in limits.columns))
    joined = counted.join(limits, F.col(lang).cast("string").eqNullSafe(F.col("__t__lang")) & F.col(source).cast("string").eqNullSafe(F.col("__t__source")), "left")
    good = ~base_failed(prefix)
    of = rates(prefix)
    for k, (both, _) in RATES.items():
        good &= F.coalesce(of[k] <= F.col(f"__t_{k}_max"), F.lit(True))
        if both:
            good &= F.coalesce(of[k] >= F.col(f"__t_{k}_min"), F.lit(True))
    return joined.withColumn(verdict, good).drop(*limits.columns)


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with the columns of ``docs``.

    Two passes over the texts (counts for the sketches, then counts and verdict)
    cost less than shuffling or storing the texts.
    """
    prefix = "__quality_"
    slim = written(with_counts(docs, text, [lang, source], prefix), "quality-counts")
    limits = written(thresholds(slim, lang, source, prefix), "quality-thresholds")
    judged = judge(with_counts(docs, text, None, prefix), limits, f"{prefix}kept", lang, source, prefix)
    return judged.where(F.col(f"{prefix}kept")).select(*(F.col(f"`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = written(with_counts(table(spark, sf_dir, "documents"), keep=["doc_id", "lang", "source"]), "quality-counts")
    judged = judge(counted, written(thresholds(counted), "quality-thresholds"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), "kept")


_SPACE = "[\\x20\\x09-\\x0D]"


def _sql() -> str:
    rate = {"symbol_rate": "n_symbols / greatest(text_chars, 1)", "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)", "repeat_rate": "n_repeat_words / greatest(n_words, 1)", "word_length": "word_chars / greatest(n_words, 1)"}
    quartiles = ", ".join(f"quantile_disc({k}, 0.25) AS {k}_1, quantile_disc({k}, 0.75) AS {k}_3" for k in RATES)

    def drawn(own: str, n: str, coarser: str) -> str:
        return f"(coalesce({n}, 0)::DOUBLE * coalesce({own}, 0.0) + {float(LEAST)}::DOUBLE * {coarser}) / (coalesce({n}, 0)::DOUBLE + {float(LEAST)}::DOUBLE)"

    tests = []
    for k, (both, slack) in RATES.items():
        low, high = (drawn(f"g.{k}_{i}", "g.n", drawn(f"l.{k}_{i}", "l.n", f"a.{k}_{i}")) for i in (1, 3))
        reach = f"({FENCE}::DOUBLE * ({high} - {low}) + {slack}::DOUBLE)"
        tests.append(f"coalesce(r.{k} <= {high} + {reach}, true)")
        if both:
            tests.append(f"coalesce(r.{k} >= {low} - {reach}, true)")
    return f"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS w FROM documents),
x AS (SELECT doc_id, i, CASE WHEN count(*) OVER (PARTITION BY doc_id, s) > 1 THEN 1 ELSE 0 END AS twice FROM (SELECT doc_id, i, w[i:i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t))),
v AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS j FROM x WHERE twice = 1) GROUP BY doc_id),
b AS (SELECT doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(t) AS text_chars, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, coalesce(v.n, 0) AS n_repeat_words
      FROM t LEFT JOIN v USING (doc_id)),
c AS (SELECT * EXCLUDE (lines), len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
r AS (SELECT *, {", ".join(f"{e} AS {k}" for k, e in rate.items())} FROM c),
g AS (SELECT lang, source, count(*) AS n, {quartiles} FROM r WHERE NOT base_failed GROUP BY lang, source),
l AS (SELECT lang, count(*) AS n, {quartiles} FROM r WHERE NOT base_failed GROUP BY lang),
a AS (SELECT {quartiles} FROM r WHERE NOT base_failed)
SELECT r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, NOT r.base_failed AND {" AND ".join(tests)} AS kept
FROM r LEFT JOIN g ON r.lang IS NOT DISTINCT FROM g.lang AND r.source IS NOT DISTINCT FROM g.source LEFT JOIN l ON r.lang IS NOT DISTINCT FROM l.lang CROSS JOIN a
"""


#: Quantiles are exact in SQL, and in the sketches for groups of fewer than ``ACCURACY`` documents.
SQL = _sql()
