"""Consistency of rows with each other: chats, responses, outputs, gold rows and exports, as reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.text import truthy
from curata.operators.review import blocking_reasons

# What a review status may be, and the tasks.
STATUSES = ("seed", "teacher_generated", "codex_reviewed", "human_reviewed", "rejected", "promoted", "draft")
TASKS = ("faq_direct_answer", "troubleshooting", "step_by_step", "clarification", "uncertainty_escalation")
REVIEWED, PROMOTABLE = ("codex_reviewed", "human_reviewed", "rejected"), ("codex_reviewed", "human_reviewed")


def reasons(rows: DataFrame, key: str, checks: Mapping[str, Column]) -> DataFrame:
    """(``key``, ``reason``) for each check whose condition holds; an unknown condition doesn't."""
    found = F.array_compact(F.array(*(F.when(test, name) for name, test in checks.items())))
    return rows.select(key, found.alias("_found")).select(key, F.explode("_found").alias("reason"))


def _other(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def _bad_status(c: Column) -> Column:
    return ~F.coalesce(c.isin(*STATUSES), F.lit(False))


def chat_faults(rows: DataFrame, key: str = "id") -> DataFrame:
    """Chats to train on: the roles of their messages, an answer, and a meta that says the same as the row."""
    m, last = F.col("messages"), F.try_element_at(F.col("messages"), F.lit(-1))
    short = F.coalesce(F.size(m), F.lit(0)) < 3
    return reasons(
        rows,
        key,
        {
            "fewer than three messages": short,
            "first message isn't the system's": ~short & (F.get(m, F.lit(0))["role"] != "system"),
            "no user message": ~short & ~F.exists(m, lambda x: x["role"] == "user"),
            "last message isn't the assistant's": ~short & (last["role"] != "assistant"),
            "empty answer": ~short & truthy(F.trim(last["content"])).isNull(),
            "chunks differ from meta": _other(F.col("source_chunk_ids"), F.col("meta.source_chunk_ids")),
            "documents differ from meta": _other(F.col("source_doc_ids"), F.col("meta.source_doc_ids")),
            "status differs from meta": _other(F.col("review_status"), F.col("meta.review_status")),
            "unknown status": _bad_status(F.col("review_status")),
            "source records don't match chunks": F.coalesce(F.size("provenance.source_records"), F.lit(0)) != F.coalesce(F.size("source_chunk_ids"), F.lit(0)),
        },
    )


def case_faults(rows: DataFrame, key: str = "eval_id") -> DataFrame:
    """Evaluation cases: a prompt, an expected behaviour, a known status, a record for each chunk."""
    blank = lambda c: truthy(F.trim(F.col(c))).isNull()
    return reasons(
        rows,
        key,
        {
            "empty prompt": blank("prompt"),
            "empty expected behaviour": blank("expected_behavior"),
            "unknown status": _bad_status(F.col("review_status")),
            "source records don't match chunks": F.coalesce(F.size("provenance.source_records"), F.lit(0)) != F.coalesce(F.size("source_chunk_ids"), F.lit(0)),
        },
    )


def link_faults(rows: DataFrame, key: str, chunks: DataFrame) -> DataFrame:
    """Chunks that rows name but nobody has, or whose document the row doesn't name. ``chunks``: chunk_id, doc_id."""
    links = rows.select(key, F.explode("source_chunk_ids").alias("chunk_id"), "source_doc_ids").join(chunks.select("chunk_id", F.col("doc_id").alias("_doc")), "chunk_id", "left")
    return reasons(links, key, {"unknown chunk": F.col("_doc").isNull(), "chunk of another document": F.col("_doc").isNotNull() & ~F.array_contains(F.coalesce("source_doc_ids", F.array().cast("array<string>")), F.col("_doc"))})


def response_faults(responses: DataFrame, jobs: DataFrame) -> DataFrame:
    """Responses against their jobs: repeated and unknown ids, fields that differ, and parsed contents that are incomplete."""
    fields = ("target_split", "task_type", "source_chunk_ids", "source_doc_ids", "teacher_prompt_version")
    j = responses.join(jobs.select("job_id", F.col("expected_output_kind").alias("_kind"), *(F.col(c).alias(f"_{c}") for c in fields)), "job_id", "left")
    known, p = F.col("_kind").isNotNull(), F.col("parsed_response")
    is_case = known & (F.col("record_type") == "eval_case")
    empty = lambda c: truthy(c).isNull()
    checks = {"unknown job": ~known, "output id isn't run and job": known & _other(F.col("output_id"), F.concat_ws("::", "teacher_run_id", "job_id")), "record_type differs": known & _other(F.col("record_type"), F.col("_kind"))}
    checks |= {f"{c} differs": known & _other(F.col(c), F.col(f"_{c}")) for c in fields}
    checks |= {
        "parsed task differs": known & _other(p["task_type"], F.col("_task_type")), "parsed chunks differ": known & _other(p["source_chunk_ids"], F.col("_source_chunk_ids")), "no answer": known & empty(p["answer"]),
        "no reference answer": is_case & empty(p["reference_answer"]), "no list of what must be in": is_case & p["rubric"]["must_include"].isNull(), "no list of what mustn't": is_case & p["rubric"]["must_not_include"].isNull(), "no style": is_case & empty(p["rubric"]["style"]),
    }
    twice = responses.groupBy("job_id").agg(F.count("*").alias("n")).where("n > 1")
    return reasons(j, "job_id", checks).unionByName(twice.select("job_id", F.lit("repeated job").alias("reason")))


def job_faults(jobs: DataFrame) -> DataFrame:
    """Jobs: one for each split, task and chunks, with statuses that are known and agree."""
    n = jobs.groupBy("target_split", "task_type", "source_chunk_ids").agg(F.min("job_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    same = F.col("a.target_split").eqNullSafe(F.col("b.target_split")) & F.col("a.task_type").eqNullSafe(F.col("b.task_type")) & F.col("a.source_chunk_ids").eqNullSafe(F.col("b.source_chunk_ids"))
    later = jobs.alias("a").join(n.alias("b"), same).where("a.job_id <> _first").select("a.job_id", F.lit("repeated split, task and chunks").alias("reason"))
    own = reasons(jobs, "job_id", {"unknown job status": _bad_status(F.col("job_status")), "unknown review status": _bad_status(F.col("review_status")), "statuses differ": _other(F.col("job_status"), F.col("review_status"))})
    return own.unionByName(later)


def output_faults(outputs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Outputs against their jobs and their candidates, the name of a reviewer, and artifacts of what was approved."""
    j = outputs.join(jobs.select("job_id", F.col("expected_output_kind").alias("_kind"), F.col("target_split").alias("_split"), F.col("source_chunk_ids").alias("_chunks")), "job_id", "left")
    known, c, status = F.col("_kind").isNotNull(), F.col("candidate"), F.col("review_status")
    text = F.coalesce(F.try_element_at(F.filter(c["messages"], lambda m: m["role"] == "assistant"), F.lit(-1))["content"], c["reference_answer"])
    return reasons(
        j,
        "output_id",
        {
            "unknown job": ~known,
            "unknown status": known & _bad_status(status),
            "kind differs from job": known & _other(F.col("record_type"), F.col("_kind")),
            "split differs from job": known & _other(F.col("target_split"), F.col("_split")),
            "chunks differ from job": known & _other(F.col("source_chunk_ids"), F.col("_chunks")),
            "no provider": known & truthy(F.col("teacher_provider")).isNull(),
            "candidate has another status": known & _other(c["review_status"], status),
            "candidate has another model": known & _other(c["teacher_model"], F.col("teacher_model")),
            "candidate has another run": known & _other(c["teacher_run_id"], F.col("teacher_run_id")),
            "candidate has another provider": known & c["teacher_provider"].isNotNull() & _other(c["teacher_provider"], F.col("teacher_provider")),
            "reviewed without a name": known & status.isin(*REVIEWED) & truthy(F.col("approved_by")).isNull(),
            "approved with artifacts": known & status.isin(*PROMOTABLE, "promoted") & (F.size(blocking_reasons(text)) > 0),
        },
    )


def gold_faults(gold: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Gold rows: promoted, from an output that is there and was approved, once; chunks of one row aren't another's."""
    o = outputs.select(F.col("output_id").alias("_origin"), F.col("review_status").alias("_status"))
    j = gold.withColumn("_from", truthy(F.col("promoted_from.output_id"))).join(o, F.col("_from") == F.col("_origin"), "left")
    own = reasons(
        j,
        key,
        {
            "not promoted": ~F.col("review_status").eqNullSafe(F.lit("promoted")),
            "no origin": F.col("_from").isNull(),
            "unknown origin": F.col("_from").isNotNull() & F.col("_origin").isNull(),
            "origin wasn't approved": F.col("_origin").isNotNull() & ~F.coalesce(F.col("_status").isin(*PROMOTABLE), F.lit(False)),
        },
    )
    ids = gold.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key, F.lit("repeated id").alias("reason"))
    uses = gold.select(key, F.explode("source_chunk_ids").alias("chunk"))
    shared = uses.groupBy("chunk").agg(F.count("*").alias("n")).where("n > 1")
    return own.unionByName(ids).unionByName(uses.join(shared, "chunk", "left_semi").select(key, F.lit("chunk used twice").alias("reason")))


def missing_tasks(rows: DataFrame, column: str = "task_type") -> DataFrame:
    """(``task``): tasks that no row has."""
    every = rows.sparkSession.createDataFrame([(t,) for t in TASKS], "task string")
    return every.join(rows.select(F.col(column).alias("task")).distinct(), "task", "left_anti")


def export_faults(train: DataFrame, evaluation: DataFrame, train_meta: DataFrame, eval_meta: DataFrame, manifest: dict) -> DataFrame:
    """(``id``, ``reason``) of an export: ids in both splits, without metadata or without a record, blank answers, shared chunks; numbers against the manifest (a null id)."""
    named = lambda df, why: df.select(F.col("id").cast("string").alias("id"), F.lit(why).alias("reason"))
    out = named(train.join(evaluation.select("id"), "id", "left_semi"), "in both splits")
    for rows, meta, split in ((train, train_meta, "train"), (evaluation, eval_meta, "eval")):
        out = out.unionByName(named(rows.join(meta.select("id"), "id", "left_anti"), f"{split} record without metadata")).unionByName(named(meta.join(rows.select("id"), "id", "left_anti"), f"{split} metadata without a record"))
        last = F.try_element_at("messages", F.lit(-1))
        out = out.unionByName(named(rows.where((last["role"] != "assistant") | truthy(F.trim(last["content"])).isNull()), "no answer"))
        count = rows.agg(F.count("*").alias("n")).where(F.col("n") != F.lit(manifest.get(f"{split}_records", -1)))
        out = out.unionByName(count.select(F.lit(None).cast("string").alias("id"), F.lit(f"manifest has another number of {split} records").alias("reason")))
    chunks = lambda df: df.select("id", F.explode("source_chunk_ids").alias("chunk"))
    return out.unionByName(named(chunks(train_meta).join(chunks(eval_meta).select("chunk"), "chunk", "left_semi").select("id").distinct(), "chunk in both splits"))
