"""Search, row differences and review contexts over datasets of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search(df: DataFrame, text: str = "", status: str | None = None, changed: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Rows whose JSON holds the text (any case), of a status, and among the changed keys, as far as given."""
    out = df
    if text:
        whole = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
        out = out.where(F.contains(F.lower(whole), F.lit(text.lower())))
    if status is not None:
        out = out.where(F.col("review_status").eqNullSafe(F.lit(status)))
    return out if changed is None else out.join(changed.select(key), key, "left_semi")


def changed_fields(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(``key``, ``fields``): which columns differ between two versions of rows, nulls being equal."""
    names = [c for c in before.columns if c != key and c in after.columns]
    a = before.select(key, *(F.col(c).alias(f"_a_{c}") for c in names))
    b = after.select(key, *(F.col(c).alias(f"_b_{c}") for c in names))
    fields = F.array_compact(F.array(*(F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), c) for c in names)))
    return a.join(b, key).select(key, fields.alias("fields")).where(F.size("fields") > 0)


def review_context(df: DataFrame) -> DataFrame:
    """Pending, decided and promotable rows of a dataset."""
    s = F.col("review_status")
    return df.agg(
        F.count_if(s.isin("draft", "seed", "teacher_generated")).alias("pending"),
        F.count_if(s.isin("human_reviewed", "rejected")).alias("decided"),
        F.count_if((s == "human_reviewed") & (F.col("record_type") == "sft_sample")).alias("eligible_train"),
        F.count_if((s == "human_reviewed") & (F.col("record_type") == "eval_case")).alias("eligible_eval"),
    )


def apply_decisions(df: DataFrame, key: str, approve: DataFrame, reject: DataFrame, reviewer: str) -> DataFrame:
    """``df`` with a person's decisions; ids in both lists or unknown are an error, other rows stay as they are."""
    both = approve.select(key).join(reject.select(key), key, "left_semi")
    given = approve.select(key, F.lit("human_reviewed").alias("_to")).unionByName(reject.select(key, F.lit("rejected").alias("_to")))
    unknown = given.join(df, key, "left_anti")
    for rows, what in ((both, "both approved and rejected"), (unknown, "unknown")):
        if found := [str(r[0]) for r in rows.select(key).limit(10).collect()]:
            raise ValueError(f"{what}: {', '.join(sorted(found))}")
    j = df.join(given.distinct(), key, "left")
    fresh = {"review_status": F.coalesce("_to", "review_status"), "approved_by": F.when(F.col("_to").isNotNull(), F.lit(reviewer)).otherwise(F.col("approved_by") if "approved_by" in df.columns else F.lit(None).cast("string"))}
    return j.withColumns(fresh).drop("_to")


def read_span(spans: DataFrame, docs: DataFrame, span: str = "span", path: str = "path", text: str = "text") -> DataFrame:
    """``spans`` with the ``excerpt`` that ``path#L1-L2`` (or ``#L1``) names, clamped; empty if there is no such document."""
    m = r"^(.+)#L(\d+)(?:-L(\d+))?$"
    first = F.regexp_extract(span, m, 2)
    last = F.coalesce(F.nullif(F.regexp_extract(span, m, 3), F.lit("")), first)
    parsed = spans.withColumns({"_path": F.regexp_extract(span, m, 1), "_a": first.try_cast("int"), "_b": last.try_cast("int")})
    j = parsed.join(docs.select(F.col(path).alias("_path"), F.split(F.col(text), "\n").alias("_lines")), "_path", "left")
    start = F.greatest(F.col("_a"), F.lit(1))
    cut = F.slice("_lines", start, F.greatest(F.col("_b") - start + 1, F.lit(0)))
    return j.withColumn("excerpt", F.coalesce(F.array_join(cut, "\n"), F.lit(""))).drop("_path", "_a", "_b", "_lines")


def excerpt(lines: Column, first: Column, last: Column, context: int = 2) -> Column:
    """Numbered lines around a span, clamped."""
    start = F.greatest(first - context, F.lit(1))
    return F.transform(F.slice(lines, start, F.greatest(last + context - start + 1, F.lit(0))), lambda x, i: F.struct((start + i).alias("number"), x.alias("line")))


def review_packet(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows by split, task, score and id, with previews."""
    from curata.functions.text import preview

    return df.orderBy("target_split", "task_type", F.desc("quality_score"), "output_id").limit(n).withColumn("preview", preview(F.col("answer"), 220))
