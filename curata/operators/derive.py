"""From reviewed rows to exports: partition, gold, chat records, metadata, leakage check, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.messages import filled, last_of


def approved(reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose review approved them, and all others."""
    good = (F.col("auto_review.decision") == "approve") & (F.col("review_status") == "codex_reviewed")
    good = F.coalesce(good, F.lit(False))
    return reviewed.where(good), reviewed.where(~good)


def controlled_gold(reviewed: DataFrame, pre_gold: DataFrame, key: str = "output_id") -> tuple[DataFrame, DataFrame]:
    """Reviewed rows that the pre-gold ids list, and the rest; every listed id must be there once."""
    kept, rest = reviewed.join(pre_gold.select(key), key, "left_semi"), reviewed.join(pre_gold.select(key), key, "left_anti")
    want, have = pre_gold.select(key).distinct().count(), kept.count()
    if want != have:
        raise ValueError(f"{want} ids are listed, {have} rows found")
    return kept, rest


def train_records(rows: DataFrame) -> DataFrame:
    """(``id``, ``messages``) of rows that end in an answer which isn't blank."""
    last = F.try_element_at("messages", F.lit(-1))
    return rows.where((F.size("messages") >= 2) & (last["role"] == "assistant") & filled(last["content"]).isNotNull()).select("id", "messages")


def eval_records(cases: DataFrame, system: str | None = None) -> DataFrame:
    """(``id``, ``messages``) of cases: optional system text, prompt, reference answer."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    parts = [*([message("system", F.lit(system))] if system else []), message("user", F.col("prompt")), message("assistant", F.col("reference_answer"))]
    return cases.where(filled(F.col("reference_answer")).isNotNull()).select(F.col("eval_id").alias("id"), F.array(*parts).alias("messages"))


METADATA = "product language task_type case_type source_doc_ids source_chunk_ids teacher_model teacher_run_id teacher_prompt_version generation_mode review_status approved_by promoted_from provenance expected_behavior reference_answer rubric".split()


def metadata(rows: DataFrame, key: str, split: str, record_type: str, gold_path: str) -> DataFrame:
    """The sidecar of an export: what a row lacks is null, lists are empty."""

    def column(name: str) -> Column:
        if name in rows.columns:
            return F.col(name)
        return F.array().cast("array<string>") if name.endswith("_ids") else F.lit(None).cast("string")

    return rows.select(F.col(key).alias("id"), F.lit(split).alias("split"), F.lit(record_type).alias("record_type"), *(column(c).alias(c) for c in METADATA), F.lit(gold_path).alias("gold_source_path"))


def split_violations(rows: DataFrame, key: str, split: str) -> DataFrame:
    """(``id``, ``reason``): ids missing or repeated, another split, not promoted, or no chunks."""
    n = rows.groupBy(F.col(key).alias("_id")).agg(F.count("*").alias("_n"))
    j = rows.join(n, rows[key].eqNullSafe(n["_id"]), "left")
    reasons = F.array_compact(
        F.array(
            F.when(F.coalesce(F.col(key), F.lit("")) == "", "missing id"),
            F.when(F.col("_n") > 1, "repeated id"),
            F.when(~F.col("split").eqNullSafe(F.lit(split)), "another split"),
            F.when(~F.col("review_status").eqNullSafe(F.lit("promoted")), "not promoted"),
            F.when(F.coalesce(F.size("source_chunk_ids"), F.lit(0)) <= 0, "no source chunks"),
        )
    )
    return j.select(F.col(key).alias("id"), F.explode(reasons).alias("reason"))


def shared_chunks(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Chunks that both splits use: must be empty."""
    ids = lambda df: df.select(F.explode("source_chunk_ids").alias("chunk_id")).distinct()
    return ids(train).join(ids(evaluation), "chunk_id", "left_semi")


def assert_empty(df: DataFrame, what: str) -> None:
    """Raises with up to ten rows if there are any."""
    if rows := df.limit(10).collect():
        raise ValueError(f"{what}: " + "; ".join(str(tuple(r)) for r in rows))


def sft_to_eval(rows: DataFrame) -> DataFrame:
    """Evaluation cases from chat rows: the last user turn asks, the last answer is the reference."""
    return rows.select(F.concat(F.lit("eval_"), F.col("id")).alias("eval_id"), last_of(F.col("messages"), "user").alias("prompt"), last_of(F.col("messages"), "assistant").alias("reference_answer"))


def doc_counts(rows: DataFrame) -> DataFrame:
    """How many rows use each source document."""
    return rows.select(F.explode("source_doc_ids").alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n"))


def manifest(export_id: str, train: DataFrame, evaluation: DataFrame) -> dict:
    """Counts, digests and document distribution of an export, with the leakage check always made."""
    from curata.sources.jsonl import row_digest

    return {
        "export_id": export_id,
        "train_rows": train.count(),
        "eval_rows": evaluation.count(),
        "train_digest": row_digest(train.select("id", "messages")),
        "eval_digest": row_digest(evaluation.select("id", "messages")),
        "split_chunk_overlap": [r.chunk_id for r in shared_chunks(train, evaluation).orderBy("chunk_id").limit(20).collect()],
        "n_docs": doc_counts(train.select("source_doc_ids").unionByName(evaluation.select("source_doc_ids"))).count(),
    }
