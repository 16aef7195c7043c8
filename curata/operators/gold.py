"""From reviewed outputs to gold rows: status propagation, promotion with its checks, candidate sets, metadata and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.text import truthy
from curata.operators.derive import approved
from curata.operators.validate import provenance_violations, schema_violations

PENDING, DECIDED = ("draft", "seed", "teacher_generated"), ("human_reviewed", "rejected")


def _has(kind: T.DataType, *path: str) -> bool:
    for name in path:
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return False
        kind = kind[name].dataType
    return True


def propagate_status(rows: DataFrame) -> DataFrame:
    """Rows whose nested candidate and meta say the same of their review as the row itself; a null status overrides nothing."""
    out = rows
    if _has(rows.schema, "candidate"):
        status, by = F.coalesce(truthy(F.col("review_status")), F.col("candidate.review_status")), F.col("approved_by")
        c = F.col("candidate").withField("review_status", status).withField("approved_by", by)
        if _has(rows.schema, "candidate", "meta"):
            own = F.coalesce(truthy(F.col("review_status")), F.col("candidate.meta.review_status"))
            c = c.withField("meta", F.when(F.col("candidate.meta").isNotNull(), F.col("candidate.meta").withField("review_status", own).withField("approved_by", by)))
        out = out.withColumn("candidate", F.when(F.col("candidate").isNotNull(), c))
    elif _has(rows.schema, "messages") and _has(rows.schema, "meta"):
        meta = F.col("meta")
        for k in ("review_status", "approved_by", "split", "promoted_from"):
            if k in rows.columns:
                meta = meta.withField(k, F.col(k))
        out = out.withColumn("meta", F.when(F.col("meta").isNotNull(), meta))
    return out


def lineage(path: str) -> Column:
    """Where a promoted row comes from."""
    return F.struct(F.lit(path.replace("\\", "/")).alias("teacher_output_path"), *(F.col(c) for c in ("output_id", "job_id", "teacher_provider", "teacher_model", "teacher_run_id")))


def promotion_faults(rows: DataFrame) -> DataFrame:
    """(``output_id``, ``reason``): what forbids a promotion of reviewed rows: unknown kinds, repeated ids, chunks of both splits, and nothing to promote (a null id)."""
    good = rows.where("review_status = 'human_reviewed'")
    known = F.col("record_type").isin("sft_sample", "eval_case")
    ids = good.groupBy("output_id").agg(F.count("*").alias("n"), F.max(~F.coalesce(known, F.lit(False))).alias("odd"))
    single = ids.select("output_id", F.explode(F.array_compact(F.array(F.when(F.col("n") > 1, "repeated id"), F.when(F.col("odd"), "unknown kind")))).alias("reason"))
    chunks = good.where(known).select("output_id", "record_type", F.explode("source_chunk_ids").alias("chunk"))
    both = chunks.groupBy("chunk").agg(F.min("record_type").alias("a"), F.max("record_type").alias("b")).where("a < b").select("chunk")
    shared = chunks.join(both, "chunk", "left_semi").select("output_id", F.lit("chunk in both splits").alias("reason")).distinct()
    none = good.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("output_id"), F.lit("nothing to promote").alias("reason"))
    return single.unionByName(shared).unionByName(none)


def promoted(rows: DataFrame, path: str, statuses: tuple[str, ...] = ("human_reviewed",)) -> DataFrame:
    """The candidates of reviewed rows as gold rows (``split``, ``candidate``), status, split and lineage set in candidate and meta alike."""
    split = F.when(F.col("record_type") == "eval_case", "eval").otherwise("train")
    marks = {"review_status": F.lit("promoted"), "split": split, "approved_by": F.col("approved_by"), "promoted_from": lineage(path)}
    c = F.col("candidate")
    for k, v in marks.items():
        c = c.withField(k, v)
    if _has(rows.schema, "candidate", "meta"):
        meta = F.col("candidate.meta")
        for k, v in marks.items():
            meta = meta.withField(k, v)
        c = c.withField("meta", F.when(F.col("record_type") == "sft_sample", meta))
    return rows.where(F.col("review_status").isin(*statuses)).select("output_id", split.alias("split"), c.alias("candidate"))


# -- checks before a file is saved ---------------------------------------------------------
# Kinds of files by the beginning of their path; the first that fits counts.
KINDS = (
    ("data/derived/teacher_outputs/", "teacher_outputs"), ("data/gold/train/", "gold_train"), ("data/gold/eval/", "gold_eval"), ("data/derived/chunks/", "chunks"), ("data/derived/task_cards/", "task_cards"),
    ("data/derived/teacher_jobs/", "teacher_jobs"),
)
EDITABLE = ("teacher_outputs", "reviewed_teacher_outputs", "gold_train", "gold_eval")


def path_kind(path: Column) -> Column:
    """The kind of a file of rows, null if it has none."""
    name = F.regexp_extract(path, "[^/]*$", 0)
    out = F.lit(None).cast("string")
    for start, kind in reversed(KINDS):
        if kind == "teacher_outputs":
            kind = F.when(path.endswith("_raw_responses.jsonl"), "raw_responses").when(name.contains("reviewed"), "reviewed_teacher_outputs").when(path.endswith("teacher_outputs.jsonl"), "teacher_outputs").otherwise("teacher_preview")
        out = F.when(path.startswith(start), kind).otherwise(out)
    return F.when(path.endswith(".jsonl"), out)


def review_path(path: Column) -> Column:
    """Where the reviewed rows of a file go."""
    renamed = F.when(path.contains("_teacher_outputs.jsonl"), F.replace(path, F.lit("_teacher_outputs.jsonl"), F.lit("_reviewed_teacher_outputs.jsonl"))).when(path.endswith(".jsonl"), F.regexp_replace(path, r"\.jsonl$", "_reviewed.jsonl")).otherwise(path)
    return F.when(path_kind(path) == "reviewed_teacher_outputs", path).otherwise(renamed)


def inside(root: str, path: str) -> str:
    """The path below a root folder, with ``..`` resolved; an error if it leads out of it."""
    import posixpath

    whole = posixpath.normpath(posixpath.join(root, path.replace("\\", "/")))
    if whole != posixpath.normpath(root) and not whole.startswith(posixpath.normpath(root) + "/"):
        raise ValueError(f"{path} leads out of {root}")
    return whole


def row_faults(rows: DataFrame, key: str, schema: dict, nested: dict[str, dict] | None = None) -> DataFrame:
    """(``key``, ``reason``): broken schema rules of rows and, by record type, of their candidates, and missing provenance."""
    found = schema_violations(rows, schema, key).unionByName(provenance_violations(rows, key))
    for kind, inner in (nested or {}).items():
        part = rows.where(F.col("record_type") == kind).select(F.col(key).alias("_key"), "candidate.*")
        bad = schema_violations(part, inner, "_key")
        found = found.unionByName(bad.select(F.col("_key").alias(key), F.concat(F.lit("candidate "), "reason").alias("reason")))
    return found


def post_checks(rows: DataFrame, key: str, schema: dict) -> DataFrame:
    """One row: ``rows``, ``schema_ok`` and ``provenance_ok`` of a saved file; a file without rows passes."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    n, bad, lost = count(rows, "rows"), count(schema_violations(rows, schema, key), "_bad"), count(provenance_violations(rows, key), "_lost")
    return n.crossJoin(bad).crossJoin(lost).select("rows", (F.col("_bad") == 0).alias("schema_ok"), (F.col("_lost") == 0).alias("provenance_ok"))  # a row each


def review_export_faults(rows: DataFrame, source: str, target: str) -> DataFrame:
    """(``output_id``, ``reason``): what forbids to save a review: wrong kinds of files, no decision at all, decisions without a name."""
    kinds = rows.sparkSession.createDataFrame([(source, target)], "s string, t string").select("s", "t", path_kind(F.col("s")).alias("from"), path_kind(F.col("t")).alias("to"))
    reviewable = lambda c: F.coalesce(F.col(c).isin("teacher_outputs", "reviewed_teacher_outputs"), F.lit(False))
    reasons = F.array_compact(F.array(F.when(~reviewable("from"), "source is no output file"), F.when((F.col("from") == "teacher_outputs") & (F.col("s") == F.col("t")), "an output file isn't overwritten"), F.when(~reviewable("to"), "target is no reviewed file")))
    none = F.lit(None).cast("string").alias("output_id")
    of_paths = kinds.select(none, F.explode(reasons).alias("reason"))
    decided = F.col("review_status").isin(*DECIDED)
    empty = rows.agg(F.count_if(decided).alias("n")).where("n = 0").select(none, F.lit("no decisions").alias("reason"))
    nameless = rows.where(decided & truthy(F.col("approved_by")).isNull()).select("output_id", F.lit("decision without a name").alias("reason"))
    return of_paths.unionByName(empty).unionByName(nameless)


# -- candidate sets --------------------------------------------------------------------------
META = "product language task_type case_type source_doc_ids source_chunk_ids teacher_provider teacher_model teacher_run_id teacher_prompt_version generation_mode expected_behavior reference_answer rubric provenance promoted_from".split()


def gold_metadata(candidates: DataFrame, gold_path: str, status: str = "promoted", **paths: str) -> DataFrame:
    """The sidecar of gold candidates (``split``, ``candidate``): what a candidate lacks is null; ``needs_clarification`` only where the task is to clarify."""
    kind = candidates.schema["candidate"].dataType
    is_eval, c = F.col("split") == "eval", F.col("candidate")
    value = lambda k: c[k] if _has(kind, k) else F.lit(None).cast("string")
    task = F.when(is_eval, F.coalesce(value("case_type"), value("task_type"))).otherwise(value("task_type"))
    columns = {k: value(k) for k in META} | {"task_type": task}
    return candidates.select(
        F.coalesce(value("id"), value("eval_id")).alias("id"), "split", F.when(is_eval, "sft_eval").otherwise("sft_train").alias("record_type"), *(v.alias(k) for k, v in columns.items()), F.lit(status).alias("review_status"), value("approved_by").alias("approved_by"),
        F.lit(gold_path.replace("\\", "/")).alias("gold_source_path"), *(F.lit(v.replace("\\", "/")).alias(k) for k, v in paths.items()), F.lit("approved_only").alias("candidate_selection_status"), F.when(~is_eval & (task == "clarification"), F.lit(True)).alias("needs_clarification"),
    )


def derivation_counts(reviewed: DataFrame) -> DataFrame:
    """(``part``, ``what``, ``key``, ``n``): approved and rejected rows by task, kind, decision and document."""
    good, rest = approved(reviewed)
    rows = good.withColumn("part", F.lit("approved")).unionByName(rest.withColumn("part", F.lit("rejected")))
    facts = F.array(
        F.struct(F.lit("all").alias("what"), F.lit("").alias("key")), F.struct(F.lit("task_type").alias("what"), F.col("task_type").alias("key")), F.struct(F.lit("record_type").alias("what"), F.col("record_type").alias("key")),
        F.struct(F.lit("decision").alias("what"), F.coalesce("auto_review.decision", F.lit("missing")).alias("key")),
    )
    docs = F.transform(F.coalesce("source_doc_ids", F.array().cast("array<string>")), lambda d: F.struct(F.lit("doc").alias("what"), d.alias("key")))
    return rows.select("part", F.explode(F.concat(facts, docs)).alias("f")).groupBy("part", "f.what", "f.key").agg(F.count("*").alias("n"))


def excluded_rows(reviewed: DataFrame) -> DataFrame:
    """The rejected rows with what was said of them; ``sensitive`` marks the tasks that stay under watch."""
    _, rest = approved(reviewed)
    return rest.select("job_id", "task_type", "record_type", F.col("auto_review.decision").alias("decision"), F.col("auto_review.quality_score").alias("quality_score"), F.col("task_type").isin("step_by_step", "clarification").alias("sensitive"))


def with_status(rows: DataFrame, status: str) -> DataFrame:
    """Rows of a review status, by their own or their meta's word."""
    own = F.col("review_status") == status
    return rows.where(F.coalesce(own, F.lit(False)) | F.coalesce(F.col("meta.review_status") == status, F.lit(False))) if _has(rows.schema, "meta", "review_status") else rows.where(own)


def notes(title: str, counts: DataFrame) -> str:
    """A derivation's counts as a page of markdown (a line for each task, kind and decision)."""
    rows = counts.where("what <> 'doc'").orderBy("part", "what", "key").collect()
    lines = [f"# {title}", ""]
    for part in sorted({r.part for r in rows}):
        lines += [f"## {part.capitalize()}", "", *(f"- {r.what} {r.key}: {r.n}".replace(" :", ":") for r in rows if r.part == part), ""]
    return "\n".join(lines)


def duplicate_rows(rows: DataFrame, *keys: str, order: str) -> DataFrame:
    """The second and later rows of each key."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n > 1").drop("_n")
