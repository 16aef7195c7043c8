"""The whole run of the model stages, from jobs to gold rows, and what is checked before rows are saved."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.text import truthy
from curata.operators import gold, materialize, review
from curata.operators.derive import approved, eval_records, train_records
from curata.operators.stages import run_stage, stage_metrics, with_batches
from curata.session import frozen
from curata.sources.jsonl import row_digest

SIMULATION = "request_text string, difficulty string, phrasing_style string, user_goal string, scenario_summary string"
ANSWER = f"answer string, needs_clarification boolean, clarification_question string, escalate boolean, uncertainty_reason string, steps array<string>, notes array<string>, case_description string, expected_behavior string, reference_answer string, rubric {materialize.RUBRIC}"
JUDGEMENT = "decision string, quality_score int, summary string, blocking_reasons array<string>"


def parsed(responses: DataFrame, schema: str, name: str) -> DataFrame:
    """(``job_id``, ``name``, ``failure``): the texts of a stage's responses as structs; one that isn't JSON of the schema fails its row."""
    value = F.from_json("text", schema)
    bad = F.when(F.col("failure").isNull() & (value.isNull() | (F.to_json(value) == "{}")), "response isn't of the schema")
    return responses.select("job_id", value.alias(name), F.coalesce("failure", bad).alias("failure"))


def _ask(rows: DataFrame, parts: list[str], rules: list[str]) -> DataFrame:
    """Jobs with their prompt: the rules, and the named columns as lines."""
    lines = [*(F.lit(r) for r in rules), *(F.concat(F.lit(f"{p.split('.')[-1]}: "), F.coalesce(F.col(p).cast("string"), F.lit(""))) for p in parts)]
    return rows.withColumns({"prompt": F.concat_ws("\n", *lines), "draft": F.lit("")})


def run(jobs: DataFrame, clients: Mapping[str, Callable[[], object]], of: materialize.Run, size: int = 8, promote: bool = False, done: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All stages: simulated users, answers, judgements, reviewed outputs and, if asked for, gold rows.

    Each stage's responses are computed once and kept; the next stage takes the jobs that it
    answered. ``done`` has responses (job_id, text) of stages that ran before, which are not asked again.
    """
    done = done or {}
    out: dict[str, DataFrame] = {}

    def stage(name: str, rows: DataFrame, schema: str, column: str) -> DataFrame:
        batched = with_batches(rows.select("job_id", "prompt", "draft"), size)
        responses = frozen(run_stage(batched, clients[name], done.get(name)))
        out[f"{name}_responses"], out[f"{name}_metrics"] = responses, stage_metrics(responses)
        return parsed(responses, schema, column)

    asked = _ask(jobs, ["task_type", "runner_input.user_message"], ["Ask as a user would."])
    simulated = stage("user_simulation", asked, SIMULATION, "s")
    out["user_simulations"] = simulated.where("failure is null").select("job_id", "s.*")
    ready = jobs.join(out["user_simulations"].select("job_id", "request_text"), "job_id")
    contract = ready.withColumn("contract", materialize.contract(F.col("task_type")))
    answered = stage("answer", _ask(contract, ["task_type", "contract", "request_text"], ["Answer from the source alone."]), ANSWER, "parsed_response")
    who = {"teacher_model": of.model, "teacher_provider": of.provider, "teacher_run_id": of.run_id, "generation_mode": "batch"}
    none = F.lit(None).cast("string")
    origin = F.struct(F.lit(of.version).alias("transform_pipeline_version"), none.alias("source_job_path"), none.alias("behavior_spec_path"), none.alias("prompt_template_path"))
    good = answered.where("failure is null").join(jobs.select("job_id", "teacher_prompt_version"), "job_id")
    responses = good.select("job_id", "parsed_response", "teacher_prompt_version", *(F.lit(v).alias(k) for k, v in who.items()), origin.alias("provenance"))
    out["outputs"] = materialize.from_responses(jobs, responses, of, simulated=out["user_simulations"])
    text = materialize.judged_text(F.col("record_type"), F.col("candidate"))
    read = out["outputs"].withColumn("answer_text", text)
    judged = stage("judge", _ask(read, ["task_type", "answer_text"], ["Judge the answer."]), JUDGEMENT, "j")
    out["judgements"] = judged.where("failure is null").select("job_id", "j.*")
    out["reviewed"] = reviewed(read, answered, out["judgements"])
    if promote:
        out["gold"] = gold.promoted(out["reviewed"], f"{of.run_id}_reviewed_teacher_outputs.jsonl", ("codex_reviewed",))
    return out


def reviewed(outputs: DataFrame, answered: DataFrame, judgements: DataFrame) -> DataFrame:
    """Outputs (with ``answer_text``) after the automatic review: the judge's decision, the gates on artifacts and on what the task asks for; candidates say the same."""
    p = answered.select("job_id", *(F.col(f"parsed_response.{c}").alias(f"_{c}") for c in ("needs_clarification", "clarification_question", "escalate", "uncertainty_reason")))
    j = outputs.join(p, "job_id").join(judgements.select("job_id", "decision", F.col("quality_score").alias("_raw"), F.col("summary").alias("_summary"), F.col("blocking_reasons").alias("_given")), "job_id")
    gates = review.alignment_reasons(F.col("task_type"), F.col("answer_text"), *(F.col(f"_{c}") for c in ("needs_clarification", "clarification_question", "escalate", "uncertainty_reason")))
    scored = j.withColumns({"_score": review.normalize_score(F.col("_raw")), "_gates": gates})
    decided = F.when(F.size("_gates") > 0, "reject").otherwise(F.col("decision"))
    r = review.auto_review(scored.withColumn("decision", decided), "answer_text", "decision", "_score", F.concat(F.coalesce("_given", F.array().cast("array<string>")), F.col("_gates")))
    auto = F.struct(F.col("final_decision").alias("decision"), F.col("_score").alias("quality_score"), F.col("_summary").alias("summary"), F.col("blocking_reasons").alias("blocking_reasons"))
    named = r.withColumns({"auto_review": auto, "approved_by": F.lit("auto_review")})
    return gold.propagate_status(named.select(*(c for c in outputs.columns if c != "answer_text"), "auto_review"))


def pre_gold(reviewed_rows: DataFrame, path: str, system: str | None = None) -> dict[str, DataFrame]:
    """A candidate set of approved rows: chat records and metadata of both splits; none approved, or a record without an answer, is an error."""
    good, rest = approved(reviewed_rows)
    if good.isEmpty():
        raise ValueError("no approved rows")
    rows = good.withColumn("split", F.when(F.col("record_type") == "eval_case", "eval").otherwise("train"))
    train, cases = (rows.where(F.col("split") == s) for s in ("train", "eval"))
    out = {"train": train_records(train.select("candidate.id", "candidate.messages")), "eval": eval_records(cases.select("candidate.eval_id", "candidate.prompt", "candidate.reference_answer"), system)}
    for name, source in (("train", train), ("eval", cases)):
        if (n := source.count()) != out[name].count():
            raise ValueError(f"some of {n} {name} rows have no answer to export")
        out[f"{name}_metadata"] = gold.gold_metadata(source.select("split", "candidate"), path, "human_reviewed", candidate_source_path=path)
    out["excluded"], out["counts"] = gold.excluded_rows(reviewed_rows), gold.derivation_counts(reviewed_rows)
    return out


def seed_rows(jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Previews of what jobs will become: numbered chat rows and evaluation cases, marked as seeds."""
    number = lambda prefix: F.format_string(f"{prefix}%04d", "number")
    from curata.operators.numbering import number_rows

    sft = number_rows(jobs.where("expected_output_kind = 'sft_sample'"), "job_id").withColumn("number", F.col("number") + 1)
    cases = number_rows(jobs.where("expected_output_kind <> 'sft_sample'"), "job_id").withColumn("number", F.col("number") + 1)
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    p = F.col("fixture_payload")
    chat = F.array(say("system", F.col("runner_input.system_message")), say("user", F.col("runner_input.user_message")), say("assistant", F.coalesce(truthy(p["assistant_message"]), p["draft_answer"])))
    a = sft.select(number("sft_").alias("id"), "job_id", "task_type", chat.alias("messages"), "source_chunk_ids", F.lit("seed").alias("review_status"))
    b = cases.select(number("eval_").alias("eval_id"), "job_id", F.col("task_type").alias("case_type"), F.col("runner_input.user_message").alias("prompt"), p["reference_answer"].alias("reference_answer"), "source_chunk_ids", F.lit("seed").alias("review_status"))
    return a, b


def payload(rows: DataFrame, path: str, faults: DataFrame) -> dict:
    """What an editor shows of a file: kind, whether it may be changed, digest, counts of statuses, and the first faults."""
    kind = rows.sparkSession.createDataFrame([(path,)], "p string").select(gold.path_kind(F.col("p")).alias("k")).first().k
    counts = {r[0]: r[1] for r in rows.groupBy(F.coalesce(truthy(F.col("review_status")), F.lit("<none>"))).count().collect()}
    return {"path": path, "kind": kind, "editable": kind in gold.EDITABLE, "digest": row_digest(rows), "status_counts": counts, "faults": [tuple(r) for r in faults.limit(50).collect()]}


def save(rows: DataFrame, target: str, seen: str | None, faults: DataFrame, to_gold: bool = False) -> str:
    """Writes rows as JSON lines if nobody changed the target since it was ``seen`` (its digest), its kind allows it and nothing is wrong; the new digest."""
    from curata.sources.jsonl import write_jsonl

    spark = rows.sparkSession
    kind = spark.createDataFrame([(target,)], "p string").select(gold.path_kind(F.col("p")).alias("k")).first().k
    if (kind or "").startswith("gold") and not to_gold:
        raise ValueError("gold files are written only on purpose")
    if found := faults.limit(5).collect():
        raise ValueError("; ".join(str(tuple(r)) for r in found))
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    now = row_digest(spark.read.schema(rows.schema).json(target)) if there else None
    if now != seen:
        raise ValueError("the file was changed meanwhile")
    kept = frozen(rows)  # the rows may come from the file that is written
    write_jsonl(kept, target, "overwrite")
    return row_digest(kept)


def promotion_export_faults(rows: DataFrame, source: str, train_path: str, eval_path: str) -> DataFrame:
    """(``output_id``, ``reason``): what forbids to promote a file of reviewed rows into two gold files."""
    kinds = rows.sparkSession.createDataFrame([(source, train_path, eval_path)], "s string, t string, e string").select(*(gold.path_kind(F.col(c)).alias(c) for c in "ste"))
    wrong = lambda c, kind: ~F.coalesce(F.col(c) == kind, F.lit(False))
    reasons = F.array_compact(F.array(F.when(wrong("s", "reviewed_teacher_outputs"), "source is no reviewed file"), F.when(wrong("t", "gold_train"), "no file of gold train"), F.when(wrong("e", "gold_eval"), "no file of gold eval")))
    return kinds.select(F.lit(None).cast("string").alias("output_id"), F.explode(reasons).alias("reason")).unionByName(gold.promotion_faults(rows))


def stage_health(responses: Mapping[str, DataFrame]) -> DataFrame:
    """A row for each stage of a run: jobs, failures, batches and prompt sizes."""
    out = None
    for name, r in responses.items():
        row = stage_metrics(r).withColumn("stage", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out
