"""Review gates, promotion and overlays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.text import ELLIPSIS, TABLE_MARK

MIN_SCORE = 70


def blocking_reasons(text: Column) -> Column:
    """Ordered reasons why a candidate text can't be used; an empty text has that reason only."""
    # fixed values: the reasons' wording
    found = F.array(
        F.when(text.rlike(ELLIPSIS), "contains ellipsis/truncation artifact"),
        F.when(text.rlike(TABLE_MARK), "contains markdown table artifact"),
        F.when(text.rlike(r"(?i)\*\*(Hinweis|Achtung|Wichtig):\*\*"), "contains note label promoted as content"),
        F.when(text.rlike(r"(?i)Verwenden Sie dazu \*\*[^*]+:\*\*\."), "contains note label misused as shortcut"),
    )
    blank = F.coalesce(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit("")) == ""
    return F.when(blank, F.array(F.lit("missing candidate text"))).otherwise(F.array_compact(found))


def normalize_score(score: Column) -> Column:
    """Scores of 0 to 10 become 0 to 100."""
    return F.when(score.between(0, 10), score * 10).otherwise(score)


def alignment_reasons(task: Column, answer: Column, needs_clarification: Column, question: Column, escalate: Column, reason: Column) -> Column:
    """Reasons why an answer doesn't fit its task."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    clarify, unsure, faq = task == "clarification", task == "uncertainty_escalation", task == "faq_direct_answer"
    # fixed values: the reasons' wording
    return F.array_compact(
        F.array(
            F.when(clarify & no(needs_clarification), "clarification task answered without needs_clarification=true"),
            F.when(clarify & blank(question), "clarification task missing clarification_question"),
            F.when(clarify & ~blank(answer) & ~F.trim(answer).endswith("?"), "clarification task does not end in a focused question"),
            F.when(unsure & no(escalate), "uncertainty_escalation task answered without escalate=true"),
            F.when(unsure & blank(reason), "uncertainty_escalation task missing uncertainty_reason"),
            F.when(faq & ~no(needs_clarification), "faq_direct_answer task should not require clarification"),
            F.when(faq & ~no(escalate), "faq_direct_answer task should not escalate"),
        )
    )


def auto_review(df: DataFrame, text: str, decision: str, score: str, reasons: Column | None = None) -> DataFrame:
    """``df`` with ``blocking_reasons``, ``final_decision`` and ``review_status``."""
    given = F.coalesce(reasons, F.array().cast("array<string>")) if reasons is not None else F.array().cast("array<string>")
    artifacts = blocking_reasons(F.col(text))
    low = (F.col(decision) == "approve") & (F.size(artifacts) == 0) & (F.col(score) < MIN_SCORE)
    every = F.array_sort(F.array_distinct(F.concat(given, artifacts, F.when(low, F.array(F.lit("approve decision below minimum quality score threshold"))).otherwise(F.array().cast("array<string>")))))
    final = F.when((F.size(artifacts) > 0) | low, "reject").otherwise(F.col(decision))
    out = df.withColumns({"blocking_reasons": every, "final_decision": final})
    approved = (F.col("final_decision") == "approve") & (F.size("blocking_reasons") == 0)
    return out.withColumn("review_status", F.when(approved, "codex_reviewed").otherwise("rejected"))


def promote(df: DataFrame, statuses: Sequence[str], text: str) -> DataFrame:
    """Rows of the given statuses without artifacts, marked as promoted from their row."""
    good = df.where(F.col("review_status").isin(*statuses) & (F.size(blocking_reasons(F.col(text))) == 0))
    return good.withColumn("promoted_from", F.col("review_status")).withColumn("review_status", F.lit("promoted"))


def split_overlap(df: DataFrame, split: str, chunk: str) -> DataFrame:
    """Chunks that both splits use, with their numbers of rows: must be empty before an export."""
    sides = df.groupBy(chunk).agg(F.count_if(F.col(split) == "train").alias("n_train"), F.count_if(F.col(split) == "eval").alias("n_eval"))
    return sides.where("n_train > 0 and n_eval > 0")


def overlay(source: DataFrame, reviewed: DataFrame, key: str, signature: Sequence[str]) -> DataFrame:
    """Every key of either side with ``state``: merged, conflict (another signature), missing (unreviewed) or extra."""
    s = source.select(F.col(key).alias("_k"), F.struct(*signature).alias("_s"), F.lit(True).alias("_in_source"))
    r = reviewed.select(F.col(key).alias("_k"), F.struct(*signature).alias("_r"), F.lit(True).alias("_in_review"))
    j = s.join(r, "_k", "full_outer")
    state = F.when(F.col("_in_review").isNull(), "missing").when(F.col("_in_source").isNull(), "extra").when(F.col("_s").eqNullSafe(F.col("_r")), "merged").otherwise("conflict")
    return j.select(F.col("_k").alias(key), state.alias("state"))
