"""Runs of model stages over ``labels`` as jobs: materialised outputs, promotion, derivation, audits and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.functions.hashing import hash_mod
from curata.operators import audits, gold, materialize, training, workflow
from curata.operators.quota import hash_split
from curata.plans.metrics import HASH_SQL
from curata.plans.selection import TASKS
from curata.session import frozen, table

RUN = materialize.Run("model", "provider", "run7", "v2")
NAMES = ["reference", "v1", "v2", "v3"]


def _h(tag: str, modulo: int) -> Column:
    return hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit(f"::{tag}")), modulo)


def _s(tag: str, modulo: int) -> str:
    return f"({HASH_SQL.format(f'doc_id::VARCHAR || chr(58) || chr(58) || {chr(39)}{tag}{chr(39)}')} % {modulo})::BIGINT"


def _task() -> Column:
    return F.get(F.array(*map(F.lit, TASKS)), _h("task", 5).cast("int"))


_TASK_SQL = "['" + "', '".join(TASKS) + f"'][{_s('task', 5)}::INT + 1]"
_ID = lambda p: F.concat(F.lit(p), F.col("doc_id").cast("string"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job for each labelled document; evaluation jobs by the split of the id."""
    none = F.lit(None).cast("string")
    is_eval = hash_split(F.col("doc_id")) == "eval"
    steps = F.when(_task() == "step_by_step", F.concat(_ID("Lead "), F.lit("\n1. one\n 2.two \n3. \nend"))).otherwise(_ID("Answer "))
    rubric = F.struct(F.array(F.lit("x")).alias("must_include"), F.array().cast("array<string>").alias("must_not_include"), F.lit("plain").alias("style"), F.when(_h("notes", 2) == 0, "watch").alias("scoring_notes"))
    record = F.struct(_ID("doc_").alias("doc_id"), _ID("chunk_").alias("chunk_id"), F.lit("Title").alias("section_title"), F.array(F.lit("p#L1")).alias("source_spans"))
    return table(spark, sf_dir, "labels").select(
        _ID("job_").alias("job_id"), F.lit("wave").alias("wave_id"), F.lit("product").alias("product"), F.lit("de").alias("language"), _task().alias("task_type"), F.when(is_eval, "eval").otherwise("train").alias("target_split"),
        F.when(is_eval, materialize.EVAL).otherwise(materialize.SFT).alias("expected_output_kind"), _h("score", 101).cast("int").alias("quality_score"), F.lit("hash").alias("selection_reason"), F.lit("prompt_v1").alias("teacher_prompt_version"),
        F.lit("spec.md").alias("behavior_spec_path"), F.lit("template.md").alias("prompt_template_path"), F.array(_ID("doc_")).alias("source_doc_ids"), F.array(_ID("chunk_")).alias("source_chunk_ids"),
        F.struct(F.lit("be brief").alias("system_message"), _ID("ask ").alias("user_message")).alias("runner_input"),
        F.struct(F.when(_h("draft", 3) > 0, steps).alias("assistant_message"), _ID("Draft ").alias("draft_answer"), F.lit("case").alias("case_description"), F.lit("behave").alias("expected_behavior"), steps.alias("reference_answer"), rubric.alias("rubric")).alias("fixture_payload"),
        F.struct(F.array(record).alias("source_records")).alias("provenance"), F.col("doc_id"), none.alias("_"),
    ).drop("_")


def responses(j: DataFrame) -> DataFrame:
    """Parsed responses to jobs, by hash: with and without steps, references and notes."""
    none = F.lit(None).cast("string")
    n = _h("answer", 4)
    answer = F.when(n == 0, _ID(" Plain ")).when(n == 1, "1. first").when(n == 2, "").otherwise("Intro")
    k = _h("steps", 3)
    steps = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(F.lit("a "), F.lit(""), F.lit("b"))).otherwise(F.array(F.lit("x")))
    parsed = F.struct(
        answer.alias("answer"), (_h("clear", 2) == 0).alias("needs_clarification"), none.alias("clarification_question"), F.lit(False).alias("escalate"), none.alias("uncertainty_reason"), steps.alias("steps"), F.array().cast("array<string>").alias("notes"),
        F.lit("case").alias("case_description"), F.lit("behave").alias("expected_behavior"), F.when(_h("ref", 3) > 0, _ID("Ref ")).alias("reference_answer"), F.col("fixture_payload.rubric").alias("rubric"),
    )
    origin = F.struct(F.when(_h("version", 2) == 0, "v9").alias("transform_pipeline_version"), F.lit("jobs.jsonl").alias("source_job_path"), F.when(_h("spec", 3) == 0, "own.md").alias("behavior_spec_path"), none.alias("prompt_template_path"))
    who = {"teacher_model": RUN.model, "teacher_provider": RUN.provider, "teacher_run_id": RUN.run_id, "teacher_prompt_version": "prompt_v3", "generation_mode": "batch"}
    return j.select("job_id", *(F.lit(v).alias(c) for c, v in who.items()), parsed.alias("parsed_response"), origin.alias("provenance"))


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = jobs(spark, sf_dir)
    return materialize.from_responses(j, responses(j), RUN)


_LAST = lambda: F.coalesce(F.element_at("candidate.messages", -1)["content"], F.col("candidate.reference_answer"))


def materialized_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs from parsed responses: what the user asks, what is answered, and what came from whom."""
    return outputs(spark, sf_dir).select(
        "output_id", "record_type", F.coalesce(F.col("candidate.id"), F.col("candidate.eval_id")).alias("candidate_id"), _LAST().alias("answer"), F.col("candidate.meta.needs_clarification").alias("needs_clarification"), F.col("candidate.rubric.scoring_notes").alias("scoring_notes"),
        F.col("candidate.provenance.transform_pipeline_version").alias("version"), F.col("candidate.provenance.behavior_spec_path").alias("spec"), F.size("candidate.messages").cast("long").alias("n_messages"), "teacher_prompt_version",
    )


def stub_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs from the jobs' own fixtures, as a judge reads them."""
    o = materialize.from_fixtures(jobs(spark, sf_dir), RUN)
    return o.select("output_id", "record_type", "generation_mode", materialize.judged_text(F.col("record_type"), F.col("candidate")).alias("judged"), F.col("candidate.meta.needs_clarification").alias("needs_clarification"))


def imported_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses made of fixtures: steps read from the answers, flags from the tasks."""
    r = materialize.fixture_responses(jobs(spark, sf_dir).where("expected_output_kind = 'eval_case' or fixture_payload.assistant_message is not null"), RUN, "a\\b.jsonl")
    p = F.col("parsed_response")
    return r.select("job_id", F.array_join(p["steps"], "|").alias("steps"), p["clarification_question"].alias("question"), p["escalate"].alias("escalate"), p["uncertainty_reason"].isNotNull().alias("has_reason"), p["case_description"].alias("case"), F.col("provenance.source_job_path").alias("path"))


def answer_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs by the contract that their task puts into the prompt."""
    return jobs(spark, sf_dir).groupBy(materialize.contract(F.col("task_type")).alias("contract")).agg(F.count("*").alias("n"))


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs after a review: decisions and names by hash."""
    o = outputs(spark, sf_dir).withColumn("doc_id", F.substring_index("job_id", "_", -1).cast("long"))
    n = _h("status", 4)
    status = F.when(n == 0, "human_reviewed").when(n == 1, "rejected").when(n == 2, "codex_reviewed").otherwise("teacher_generated")
    return o.withColumns({"review_status": status, "approved_by": F.when((n < 2) & (_h("name", 5) > 0), "reviewer")}).withColumn("auto_review", F.struct(F.when(_h("auto", 3) > 0, "approve").when(_h("auto", 6) == 0, "reject").alias("decision"), F.col("quality_score").alias("quality_score")))


def status_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of rows, their candidates and metas after they were made to agree: by combination."""
    p = gold.propagate_status(_reviewed(spark, sf_dir))
    return p.groupBy("review_status", F.col("candidate.review_status").alias("candidate_status"), F.col("candidate.meta.review_status").alias("meta_status"), F.col("candidate.approved_by").alias("by")).agg(F.count("*").alias("n"))


def promoted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows of what a person approved, with their lineage."""
    p = gold.promoted(_reviewed(spark, sf_dir), "in\\x.jsonl")
    c = F.col("candidate")
    return p.select("output_id", "split", c["review_status"].alias("status"), c["meta"]["split"].alias("meta_split"), c["approved_by"].alias("by"), c["promoted_from"]["output_id"].alias("origin"), c["promoted_from"]["teacher_output_path"].alias("path"))


def gold_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of gold rows: by split, task and whether they ask to clarify."""
    m = gold.gold_metadata(gold.promoted(_reviewed(spark, sf_dir), "in.jsonl"), "data\\gold.jsonl", pre_gold_source_path="pre")
    return m.groupBy("split", "record_type", "task_type", "needs_clarification", "gold_source_path", "candidate_selection_status").agg(F.count("*").alias("n"), F.count("rubric").alias("n_rubrics"))


def promotion_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What forbids a promotion, in rows some of which share ids and chunks."""
    rows = table(spark, sf_dir, "labels").select(
        F.when(_h("twice", 9) == 0, F.concat(F.lit("o"), F.floor(F.col("doc_id") / 40).cast("string"))).otherwise(_ID("p")).alias("output_id"), F.when(_h("kind", 30) == 0, "note").when(_h("kind", 5) == 0, "eval_case").otherwise("sft_sample").alias("record_type"),
        F.when(_h("status", 2) == 0, "human_reviewed").otherwise("rejected").alias("review_status"), F.array(F.floor(F.col("doc_id") / 6)).alias("source_chunk_ids"),
    )
    return gold.promotion_faults(rows)


def review_export_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What forbids to save a review over its own source, by reason."""
    path = "data/derived/teacher_outputs/w/w_teacher_outputs.jsonl"
    return gold.review_export_faults(_reviewed(spark, sf_dir), path, path).groupBy("reason").agg(F.count("*").alias("n"))


def derivation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved and rejected rows of a derivation by task, kind and decision."""
    return gold.derivation_counts(_reviewed(spark, sf_dir)).where("what <> 'doc'")


def excluded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows with their decisions; tasks under watch are marked."""
    return gold.excluded_rows(_reviewed(spark, sf_dir))


# -- audits ---------------------------------------------------------------------------------
def runs(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Four judge runs over labelled documents: decisions, scores and answers by hash, each lacking some rows."""
    labels = table(spark, sf_dir, "labels")
    made = {}
    for i, name in enumerate(NAMES):
        score = _h(f"score{i}", 101)
        decision = F.when(_h(f"none{i}", 19) > 0, F.when(score >= 45, "approve").otherwise("reject"))
        own = F.when((F.lit(i) > 0) & (_h("same", 2) == 0), _h("answer", 3)).otherwise(_h(f"answer{i}", 3))
        judged = labels.where(_h(f"gonej{i}", 11) > 0).select(F.col("doc_id").alias("job_id"), _task().alias("task_type"), decision.alias("decision"), F.when(_h(f"blank{i}", 17) > 0, score).alias("quality_score"))
        reviewed = labels.where(_h(f"goner{i}", 13) > 0).select(F.col("doc_id").alias("job_id"), _task().alias("task_type"), F.when(own > 0, F.concat(F.lit("text "), own.cast("string"))).alias("answer"))
        made[name] = (judged, reviewed)
    return made


FOCUS = ["step_by_step", "clarification", "troubleshooting"]


def borderline_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases of four runs that tags single out, with the class of their disagreement."""
    b = audits.borderline(runs(spark, sf_dir), FOCUS, per_task=40)
    return b.select("job_id", "task_type", F.col("place").cast("long").alias("place"), F.array_join("tags", ",").alias("tags"), "score_spread", "hint", "same_answer", "changed")


def borderline_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the audit with thresholds that hardly anything meets, so that most tasks are filled up with their most telling cases."""
    b = audits.borderline(runs(spark, sf_dir), FOCUS, spread=95, approve_most=44, reject_least=46, per_task=400)
    return b.select("job_id", "task_type", F.array_join("tags", ",").alias("tags"))


def borderline_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the runs of the audited cases differ."""
    return audits.patterns(frozen(audits.borderline(runs(spark, sf_dir), FOCUS, per_task=40)), NAMES)


def clarification_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cases of the clarification task that any run has, by how they disagree."""
    return audits.clarification(runs(spark, sf_dir)).select("job_id", *(F.col(f"d_{n}") for n in NAMES), "hint", *(F.col(f"differs_{n}") for n in NAMES[1:]))


def pair_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases of two runs that tags single out, with both answers."""
    r = runs(spark, sf_dir)
    return audits.pair(r["reference"], r["v1"], ["clarification"]).withColumn("tags", F.array_join("tags", ","))


def pair_case_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags, tasks and decisions of the pair audit."""
    r = runs(spark, sf_dir)
    return audits.pair_counts(audits.pair(r["reference"], r["v1"], ["clarification"]))


def dataset_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two gold rows of each task and split, tasks in their order, five of a split at most."""
    p = gold.promoted(_reviewed(spark, sf_dir), "in.jsonl")
    task = F.col("candidate.task_type")
    two = F.row_number().over(Window.partitionBy("split", task).orderBy("output_id"))
    ranked = p.select("split", task.alias("task_type"), "output_id", F.element_at("candidate.source_doc_ids", 1).alias("doc"), F.array_position(F.array(*map(F.lit, TASKS)), task).alias("place"), two.alias("n")).where("n <= 2")
    return ranked.withColumn("at", F.row_number().over(Window.partitionBy("split").orderBy("place", "n"))).where("at <= 5").select("split", "task_type", "output_id", "doc", F.col("at").cast("long").alias("at"))


def _artifacts(spark: SparkSession, sf_dir: str, i: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    labels = table(spark, sf_dir, "labels")
    records = F.when(_h(f"bare{i}", 50) > 0, F.array(F.lit("r"))).otherwise(F.array().cast("array<string>")).alias("source_records")
    score = _h(f"score{i}", 101)
    out = labels.where(_h(f"out{i}", 30) > 0).select(F.when(hash_split(F.col("doc_id")) == "eval", "eval_case").otherwise("sft_sample").alias("record_type"), records)
    rev = labels.where(_h(f"rev{i}", 20) > 0).select(F.when(score >= 45, "codex_reviewed").otherwise("rejected").alias("review_status"), records)
    judged = labels.where(_h(f"rev{i}", 20) > 0).select(F.when(score >= 45, "approve").otherwise("reject").alias("decision"), F.when(_h(f"blank{i}", 17) > 0, score).alias("quality_score"), records)
    return out, rev, judged


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of one run's artifacts."""
    return audits.run_summary(*_artifacts(spark, sf_dir, 0))


def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' summaries side by side with their deltas."""
    return audits.compare(audits.run_summary(*_artifacts(spark, sf_dir, 0)), audits.run_summary(*_artifacts(spark, sf_dir, 1)))


def judge_run_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs that two complete runs decide or score differently; outside the focus only other decisions."""
    labels = table(spark, sf_dir, "labels")
    run = lambda i: labels.select(F.col("doc_id").alias("job_id"), _task().alias("task_type"), F.when(_h(f"score{i}", 101) >= 45, "approve").otherwise("reject").alias("decision"), _h(f"score{i}", 101).alias("quality_score"))
    return audits.run_delta(run(0), run(1), ["clarification"])


def normalized_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of pages taken as raw files against their normalized documents, some spoiled by hash."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"))
    raw = pages.where(_h("lost", 40) > 0).select(_ID("s").alias("stem"), _ID("raw/").alias("source_file"))
    done = pages.where(_h("todo", 30) > 0).select(
        _ID("s").alias("stem"), F.when(_h("file", 25) == 0, "elsewhere").otherwise(_ID("raw/")).alias("source_file"), F.when(_h("product", 35) == 0, "other").otherwise("p").alias("product"), F.lit("de").alias("language"),
        F.when(_h("stage", 45) > 0, "raw_html_to_normalized_markdown").alias("conversion_stage"), F.when(_h("twice", 20) == 0, "same").otherwise(_ID("d")).alias("doc_id"),
    )
    return training.pair_faults(raw, done, "p", "de")


def seed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered previews of jobs, chats and cases alike."""
    chats, cases = workflow.seed_rows(jobs(spark, sf_dir))
    a = chats.select("id", "job_id", F.col("task_type").alias("task"), F.element_at("messages", -1)["content"].alias("answer"))
    return a.unionByName(cases.select(F.col("eval_id").alias("id"), "job_id", F.col("case_type").alias("task"), F.col("reference_answer").alias("answer")))


def pre_gold_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat records of the approved rows of a review, by split."""
    r = _reviewed(spark, sf_dir).where("record_type = 'eval_case' or trim(element_at(candidate.messages, -1).content) <> ''").where("record_type <> 'eval_case' or candidate.reference_answer <> ''")
    p = workflow.pre_gold(r, "in.jsonl", "sys")
    row = lambda split: p[split].join(p[f"{split}_metadata"].select("id", "task_type"), "id").select(F.lit(split).alias("split"), "id", "task_type", F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), F.element_at("messages", -1)["content"].alias("answer"))
    return row("train").unionByName(row("eval"))


QUERIES = {
    f.__name__: f
    for f in (
        materialized_outputs, stub_outputs, imported_responses, answer_contracts, status_propagation, promoted_rows, gold_sidecar, promotion_faults, review_export_faults, derivation_counts, excluded_rows,
        borderline_audit, borderline_backfill, borderline_patterns, pair_cases, pair_case_counts, dataset_samples, clarification_audit, run_summary, run_comparison, judge_run_delta, normalized_pairs, seed_samples, pre_gold_records,
    )
}

# -- the same in SQL ---------------------------------------------------------------------------
_SPLIT = f"CASE WHEN {HASH_SQL.format('doc_id::VARCHAR')} % 7 = 0 THEN 'eval' ELSE 'train' END"
_J = f"""j AS (SELECT doc_id, 'job_' || doc_id AS job_id, {_TASK_SQL} AS task, {_SPLIT} AS split, {_SPLIT} = 'eval' AS is_eval, {_s('score', 101)} AS quality_score,
  CASE WHEN {_TASK_SQL} = 'step_by_step' THEN 'Lead ' || doc_id || chr(10) || '1. one' || chr(10) || ' 2.two ' || chr(10) || '3. ' || chr(10) || 'end' ELSE 'Answer ' || doc_id END AS fixture FROM labels)"""
_VISIBLE = "CASE WHEN task <> 'step_by_step' OR len(st) = 0 OR starts_with(base, '1.') THEN base WHEN base = '' THEN numbered ELSE base || chr(10) || chr(10) || numbered END"
_O = f"""{_J},
p AS (SELECT *, CASE {_s('answer', 4)} WHEN 0 THEN ' Plain ' || doc_id WHEN 1 THEN '1. first' WHEN 2 THEN '' ELSE 'Intro' END AS raw, CASE {_s('steps', 3)} WHEN 0 THEN [] WHEN 1 THEN ['a', 'b'] ELSE ['x'] END AS st, CASE WHEN {_s('ref', 3)} > 0 THEN 'Ref ' || doc_id END AS ref FROM j),
q AS (SELECT *, trim(CASE WHEN is_eval THEN coalesce(ref, raw) ELSE raw END) AS base, array_to_string(list_transform(st, lambda x, i: i || '. ' || x), chr(10)) AS numbered FROM p),
o AS (SELECT *, 'run7::' || job_id AS output_id, CASE WHEN is_eval THEN 'eval_case' ELSE 'sft_sample' END AS record_type, {_VISIBLE} AS answer FROM q)"""
_R = f"""{_O},
r AS (SELECT *, CASE {_s('status', 4)} WHEN 0 THEN 'human_reviewed' WHEN 1 THEN 'rejected' WHEN 2 THEN 'codex_reviewed' ELSE 'teacher_generated' END AS review_status, CASE WHEN {_s('status', 4)} < 2 AND {_s('name', 5)} > 0 THEN 'reviewer' END AS approved_by,
  CASE WHEN {_s('auto', 3)} > 0 THEN 'approve' WHEN {_s('auto', 6)} = 0 THEN 'reject' END AS decision FROM o),
g AS (SELECT *, coalesce(decision = 'approve' AND review_status = 'codex_reviewed', false) AS good FROM r)"""


def _run_sql() -> str:
    parts = []
    for i in range(4):
        own = f"CASE WHEN {_s('same', 2)} = 0 THEN {_s('answer', 3)} ELSE {_s(f'answer{i}', 3)} END" if i else _s("answer0", 3)
        parts.append(f"""{_s(f'gonej{i}', 11)} > 0 AS j{i}, {_s(f'goner{i}', 13)} > 0 AS r{i}, CASE WHEN {_s(f'gonej{i}', 11)} > 0 AND {_s(f'none{i}', 19)} > 0 THEN CASE WHEN {_s(f'score{i}', 101)} >= 45 THEN 'approve' ELSE 'reject' END ELSE 'missing' END AS d{i},
          CASE WHEN {_s(f'blank{i}', 17)} > 0 THEN {_s(f'score{i}', 101)} END AS s{i}, CASE WHEN {own} > 0 THEN 'text ' || {own} ELSE '' END AS a{i}""")
    return f"w AS (SELECT doc_id AS job_id, {_TASK_SQL} AS task, {', '.join(parts)} FROM labels)"


def _borderline_sql(spread: int, approve: int, reject: int, per: int) -> str:
    differs = [f"(d0 <> 'missing' AND d{i} <> 'missing' AND d{i} <> d0)" for i in (1, 2, 3)]
    tags = [f"CASE WHEN {t} THEN 'decision_mismatch_vs_codex:v{i + 1}' END" for i, t in enumerate(differs)]
    tags.append("CASE WHEN len(votes) > 1 THEN 'openrouter_internal_decision_disagreement' END")
    tags.append(f"CASE WHEN spread >= {spread} THEN 'high_score_spread>={spread}' END")
    tags.append("CASE WHEN " + " OR ".join(f"(d{i} = 'approve' AND coalesce(s{i}, 0) <= {approve})" for i in range(4)) + f" THEN 'borderline_approve<={approve}' END")
    tags.append("CASE WHEN " + " OR ".join(f"(d{i} = 'reject' AND coalesce(s{i}, 0) >= {reject})" for i in range(4)) + f" THEN 'borderline_reject>={reject}' END")
    far = ", ".join(f"CASE d{i} WHEN 'approve' THEN abs(s{i} - {approve}) WHEN 'reject' THEN abs(s{i} - {reject}) END" for i in range(4))
    focus = "['" + "', '".join(FOCUS) + "']"
    return f"""{_run_sql()},
      c AS (SELECT *, list_distinct(list_filter([d1, d2, d3], lambda x: x <> 'missing')) AS votes, list_max([s0, s1, s2, s3]) - list_min([s0, s1, s2, s3]) AS spread, list_filter([a1, a2, a3], lambda x: x <> '') AS texts
            FROM w WHERE j0 AND j1 AND j2 AND j3 AND r0 AND r1 AND r2 AND r3 AND task IN ('{"', '".join(FOCUS)}')),
      t AS (SELECT *, len(list_distinct(texts)) <= 1 AS same_answer, len(list_filter(texts, lambda x: x <> a0)) > 0 AS changed, list_filter([{', '.join(tags)}], lambda x: x IS NOT NULL) AS tags,
            {' + '.join(f"{d}::INT" for d in differs)} + (len(list_distinct([d1, d2, d3])) > 1)::INT AS much, coalesce(list_min([{far}]), 999) AS far FROM c),
      k AS (SELECT *, len(tags) > 0 AS prim, row_number() OVER (PARTITION BY task, len(tags) > 0 ORDER BY much DESC, coalesce(spread, 0) DESC, far, job_id) AS rank, count(*) FILTER (WHERE len(tags) > 0) OVER (PARTITION BY task) AS have FROM t),
      b AS (SELECT *, list_position({focus}, task) AS place, ['focus_task_type:' || task] || tags || CASE WHEN prim THEN [] ELSE ['task_coverage_backfill'] END AS all_tags,
            CASE WHEN len(votes) > 1 THEN CASE WHEN same_answer THEN 'same_answer_judge_instability' ELSE 'answer_and_judge_shift' END WHEN d0 = 'missing' THEN 'insufficient_codex_reference' WHEN len(votes) = 0 THEN 'missing_openrouter_signal'
            WHEN d0 <> votes[1] THEN CASE WHEN changed THEN 'answer_quality_gain_or_loss' ELSE 'judge_calibration_conflict' END WHEN spread >= 20 THEN 'reasoning_drift_same_decision' ELSE 'stable_borderline' END AS hint
            FROM k WHERE prim OR rank <= {per} - have)"""


def _artifact_sql(i: int) -> str:
    bare, gone = f"{_s(f'bare{i}', 50)} = 0", f"{_s(f'rev{i}', 20)} > 0"
    return f"""(SELECT count(*) FILTER (WHERE {_s(f'out{i}', 30)} > 0) AS output_rows, count(*) FILTER (WHERE {_s(f'out{i}', 30)} > 0 AND {bare}) AS outputs_without_sources, count(*) FILTER (WHERE {_s(f'out{i}', 30)} > 0 AND {_SPLIT} = 'train') AS sft_rows,
      count(*) FILTER (WHERE {_s(f'out{i}', 30)} > 0 AND {_SPLIT} = 'eval') AS eval_rows, count(*) FILTER (WHERE {gone}) AS reviewed_rows, count(*) FILTER (WHERE {gone} AND {bare}) AS reviewed_without_sources,
      count(*) FILTER (WHERE {gone} AND {_s(f'score{i}', 101)} >= 45) AS approved_jobs, count(*) FILTER (WHERE {gone} AND {_s(f'score{i}', 101)} < 45) AS rejected_jobs,
      round(avg({_s(f'score{i}', 101)}) FILTER (WHERE {gone} AND {_s(f'blank{i}', 17)} > 0), 2) AS average_quality_score FROM labels)"""


_PAIRS = f"""WITH {_run_sql()}, p AS (SELECT *, s1 - s0 AS delta, d0 || '->' || d1 AS decisions, list_filter([CASE WHEN task = 'clarification' THEN 'focus_task_type:clarification' END, CASE WHEN d0 <> d1 THEN 'decision_disagreement' END,
  CASE WHEN abs(s1 - s0) >= 20 THEN 'high_score_delta>=20' END], lambda x: x IS NOT NULL) AS tags FROM w WHERE j0 AND j1 AND r0 AND r1)"""
_CASES = f"WITH {_borderline_sql(20, 80, 60, 40)}"
_PATTERNS = [
    *(f"CASE WHEN {t} THEN ['v{i}', '{p}'] END" for i in (1, 2, 3) for p, t in (("approve_when_codex_rejects", f"d0 = 'reject' AND d{i} = 'approve'"), ("reject_when_codex_approves", f"d0 = 'approve' AND d{i} = 'reject'"), ("same_decision_high_score_delta", f"d0 = d{i} AND d0 <> 'missing' AND abs(s{i} - s0) >= 20"))),
    *(f"CASE WHEN {t} THEN ['all', '{p}'] END" for p, t in (("stable_across_openrouter_versions", "d1 = d2 AND d2 = d3"), ("openrouter_internal_disagreement", "NOT (d1 = d2 AND d2 = d3)"), ("two_approve_one_reject", "list_sort([d1, d2, d3]) = ['approve', 'approve', 'reject']"), ("two_reject_one_approve", "list_sort([d1, d2, d3]) = ['approve', 'reject', 'reject']"))),
]
_CONTRACT = "CASE task " + " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in materialize.CONTRACTS.items()) + f" ELSE '{materialize.CONTRACT_ELSE}' END"
ORACLES = {
    "materialized_outputs": f"""WITH {_O} SELECT output_id, record_type, job_id || '__candidate' AS candidate_id, answer, CASE WHEN NOT is_eval THEN {_s('clear', 2)} = 0 END AS needs_clarification, CASE WHEN is_eval THEN CASE WHEN {_s('notes', 2)} = 0 THEN 'watch' ELSE '' END END AS scoring_notes,
        CASE WHEN {_s('version', 2)} = 0 THEN 'v9' ELSE 'v2' END AS version, CASE WHEN {_s('spec', 3)} = 0 THEN 'own.md' ELSE 'spec.md' END AS spec, CASE WHEN NOT is_eval THEN 3 END AS n_messages, 'prompt_v3' AS teacher_prompt_version FROM o""",
    "stub_outputs": f"""WITH {_J}, a AS (SELECT *, CASE WHEN is_eval OR {_s('draft', 3)} > 0 THEN fixture ELSE 'Draft ' || doc_id END AS text FROM j)
        SELECT 'run7::' || job_id AS output_id, CASE WHEN is_eval THEN 'eval_case' ELSE 'sft_sample' END AS record_type, 'teacher_runner_stub' AS generation_mode, array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x)), chr(10)) AS judged,
        CASE WHEN NOT is_eval THEN task = 'clarification' END AS needs_clarification FROM a""",
    "imported_responses": f"""WITH {_J} SELECT job_id, CASE WHEN task = 'step_by_step' THEN 'one|two| ' ELSE '' END AS steps, CASE WHEN task = 'clarification' THEN fixture END AS question, task = 'uncertainty_escalation' AS escalate, task = 'uncertainty_escalation' AS has_reason,
        CASE WHEN is_eval THEN 'case' END AS case, 'a/b.jsonl' AS path FROM j WHERE is_eval OR {_s('draft', 3)} > 0""",
    "answer_contracts": f"WITH {_J} SELECT {_CONTRACT} AS contract, count(*) AS n FROM j GROUP BY 1",
    "status_propagation": f"WITH {_R} SELECT review_status, review_status AS candidate_status, CASE WHEN NOT is_eval THEN review_status END AS meta_status, approved_by AS by, count(*) AS n FROM r GROUP BY ALL",
    "promoted_rows": f"WITH {_R} SELECT output_id, split, 'promoted' AS status, CASE WHEN NOT is_eval THEN 'train' END AS meta_split, approved_by AS by, output_id AS origin, 'in/x.jsonl' AS path FROM r WHERE review_status = 'human_reviewed'",
    "gold_sidecar": f"""WITH {_R} SELECT split, CASE WHEN is_eval THEN 'sft_eval' ELSE 'sft_train' END AS record_type, task AS task_type, CASE WHEN NOT is_eval AND task = 'clarification' THEN true END AS needs_clarification, 'data/gold.jsonl' AS gold_source_path, 'approved_only' AS candidate_selection_status,
        count(*) AS n, count(*) FILTER (WHERE is_eval) AS n_rubrics FROM r WHERE review_status = 'human_reviewed' GROUP BY ALL""",
    "promotion_faults": f"""WITH l AS (SELECT CASE WHEN {_s('twice', 9)} = 0 THEN 'o' || (doc_id // 40) ELSE 'p' || doc_id END AS output_id, CASE WHEN {_s('kind', 30)} = 0 THEN 'note' WHEN {_s('kind', 5)} = 0 THEN 'eval_case' ELSE 'sft_sample' END AS kind, doc_id // 6 AS chunk FROM labels WHERE {_s('status', 2)} = 0),
        b AS (SELECT chunk FROM l WHERE kind <> 'note' GROUP BY chunk HAVING count(DISTINCT kind) > 1)
        SELECT output_id, 'repeated id' AS reason FROM l GROUP BY output_id HAVING count(*) > 1 UNION ALL SELECT DISTINCT output_id, 'unknown kind' FROM l WHERE kind = 'note'
        UNION ALL SELECT DISTINCT output_id, 'chunk in both splits' FROM l WHERE kind <> 'note' AND chunk IN (SELECT chunk FROM b) UNION ALL SELECT NULL, 'nothing to promote' WHERE (SELECT count(*) FROM l) = 0""",
    "review_export_faults": f"WITH {_R} SELECT 'decision without a name' AS reason, count(*) AS n FROM r WHERE review_status IN ('human_reviewed', 'rejected') AND approved_by IS NULL HAVING count(*) > 0 UNION ALL SELECT 'an output file isn''t overwritten', 1",
    "derivation_counts": f"""WITH {_R}, f AS (SELECT CASE WHEN good THEN 'approved' ELSE 'rejected' END AS part, unnest([['all', ''], ['task_type', task], ['record_type', record_type], ['decision', coalesce(decision, 'missing')]]) AS f FROM g)
        SELECT part, f[1] AS what, f[2] AS key, count(*) AS n FROM f GROUP BY ALL""",
    "excluded_rows": f"WITH {_R} SELECT job_id, task AS task_type, record_type, decision, quality_score, task IN ('step_by_step', 'clarification') AS sensitive FROM g WHERE NOT good",
    "borderline_audit": f"{_CASES} SELECT job_id, task AS task_type, place, array_to_string(all_tags, ',') AS tags, spread AS score_spread, hint, same_answer, changed FROM b",
    "borderline_backfill": f"WITH {_borderline_sql(95, 44, 46, 400)} SELECT job_id, task AS task_type, array_to_string(all_tags, ',') AS tags FROM b",
    "borderline_patterns": f"{_CASES}, f AS (SELECT unnest([{', '.join(_PATTERNS)}]) AS f FROM b) SELECT f[1] AS run, f[2] AS pattern, count(*) AS n FROM f WHERE f IS NOT NULL GROUP BY ALL",
    "pair_cases": f"{_PAIRS} SELECT job_id, task AS task_type, array_to_string(tags, ',') AS tags, delta, decisions, a0 AS reference_answer, a1 AS candidate_answer FROM p WHERE len(tags) > 0",
    "pair_case_counts": f"""{_PAIRS}, f AS (SELECT unnest(list_transform(tags, lambda x: ['tag', x]) || [['task_type', task], ['decisions', decisions]]) AS f FROM p WHERE len(tags) > 0) SELECT f[1] AS what, f[2] AS key, count(*) AS n FROM f GROUP BY ALL""",
    "dataset_samples": f"""WITH {_R}, n AS (SELECT split, task, output_id, 'doc_' || doc_id AS doc, row_number() OVER (PARTITION BY split, task ORDER BY output_id) AS n FROM r WHERE review_status = 'human_reviewed'),
        a AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY list_position(['{"', '".join(TASKS)}'], task), n) AS "at" FROM n WHERE n <= 2)
        SELECT split, task AS task_type, output_id, doc, "at" FROM a WHERE "at" <= 5""",
    "clarification_audit": f"""WITH {_run_sql()}, c AS (SELECT *, list_distinct(list_filter([d1, d2, d3], lambda x: x <> 'missing')) AS votes FROM w WHERE task = 'clarification' AND (j0 OR j1 OR j2 OR j3 OR r0 OR r1 OR r2 OR r3))
        SELECT job_id, d0 AS d_reference, d1 AS d_v1, d2 AS d_v2, d3 AS d_v3, CASE WHEN len(votes) <= 1 AND (len(votes) = 0 OR list_contains(votes, d0)) THEN 'stable_alignment' WHEN d1 = d2 AND d3 <> d2 AND d3 <> 'missing' THEN 'v3_outlier'
        WHEN d0 <> 'missing' AND NOT list_contains(votes, d0) THEN 'systematic_openrouter_disagreement' ELSE 'mixed_signal' END AS hint, {', '.join(f"d{i} <> d0 AND d{i} <> 'missing' AND d0 <> 'missing' AS differs_v{i}" for i in (1, 2, 3))} FROM c""",
    "run_summary": f"""SELECT *, reviewed_rows AS judge_rows, reviewed_without_sources AS judged_without_sources, approved_jobs AS approve_decisions, rejected_jobs AS reject_decisions, round(approved_jobs / reviewed_rows, 4) AS approval_rate, outputs_without_sources + reviewed_without_sources = 0 AS sources_ok FROM {_artifact_sql(0)}""",
    "run_comparison": f"""WITH s AS (SELECT a.*, b.* FROM {_artifact_sql(0)} a, (SELECT output_rows AS o1, reviewed_rows AS r1, approved_jobs AS a1, rejected_jobs AS j1, average_quality_score AS q1 FROM {_artifact_sql(1)}) b)
        SELECT what, reference, candidate, round(candidate - reference, 4) AS delta FROM (SELECT unnest(['output_rows', 'reviewed_rows', 'approved_jobs', 'rejected_jobs', 'approval_rate', 'average_quality_score']) AS what,
          unnest([output_rows, reviewed_rows, approved_jobs, rejected_jobs, round(approved_jobs / reviewed_rows, 4), average_quality_score]::DOUBLE[]) AS reference, unnest([o1, r1, a1, j1, round(a1 / r1, 4), q1]::DOUBLE[]) AS candidate FROM s)""",
    "judge_run_delta": f"""WITH r AS (SELECT doc_id AS job_id, {_TASK_SQL} AS task_type, {_s('score0', 101)} AS old_score, {_s('score1', 101)} AS new_score FROM labels),
        d AS (SELECT *, CASE WHEN old_score >= 45 THEN 'approve' ELSE 'reject' END AS old_decision, CASE WHEN new_score >= 45 THEN 'approve' ELSE 'reject' END AS new_decision, new_score - old_score AS delta FROM r)
        SELECT * FROM d WHERE old_decision <> new_decision OR (delta <> 0 AND task_type = 'clarification')""",
    "seed_samples": f"""WITH {_J} SELECT CASE WHEN is_eval THEN 'eval_' ELSE 'sft_' END || format('{{:04d}}', row_number() OVER (PARTITION BY is_eval ORDER BY job_id)) AS id, job_id, task,
        CASE WHEN is_eval OR {_s('draft', 3)} > 0 THEN fixture ELSE 'Draft ' || doc_id END AS answer FROM j""",
    "pre_gold_records": f"""WITH {_R} SELECT split, job_id || '__candidate' AS id, task AS task_type, 'system,user,assistant' AS roles, answer FROM g WHERE good AND answer <> ''""",
    "normalized_pairs": f"""WITH p AS (SELECT page_id AS doc_id FROM pages), x AS (SELECT *, 's' || doc_id AS stem, {_s('lost', 40)} > 0 AS raw, {_s('todo', 30)} > 0 AS done, {_s('twice', 20)} = 0 AS same FROM p),
        f AS (SELECT stem, unnest([CASE WHEN NOT done THEN 'not normalized' END, CASE WHEN NOT raw THEN 'no raw file' END, CASE WHEN raw AND done AND {_s('file', 25)} = 0 THEN 'another source file' END, CASE WHEN raw AND done AND {_s('product', 35)} = 0 THEN 'another product' END,
          CASE WHEN raw AND done AND {_s('stage', 45)} = 0 THEN 'another stage' END]) AS reason FROM x WHERE raw OR done)
        SELECT stem, reason FROM f WHERE reason IS NOT NULL UNION ALL SELECT stem, 'repeated id' FROM x WHERE done AND same AND (SELECT count(*) FROM x WHERE done AND same) > 1""",
}
