"""The corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, BPE.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs.

A null or empty text has no words, so the quality rules reject it; a null language or
source is a group of its own. Documents of one id are one document for the line dedup, and
of those with equal texts one stays; a document without an id is in no group of
near-duplicates and stays. Of equal documents the one with the smallest id stays. Texts of
any length pass whole. An empty table passes through all stages, and columns beside those of
``documents`` stay, except that the last stage's take the place of columns of their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import bpe, decontamination, line_dedup, quality_rules, simhash
from curata.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats, exactly or, if they are long, with one edit, go."""
    return line_dedup.remove_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and what these decode to."""
    import public_tokenizers

    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("bpe", tokenize),
]

#: SQL can't express SimHash, decontamination and BPE; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
