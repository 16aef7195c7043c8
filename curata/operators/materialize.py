"""From jobs and responses to output rows with their candidates: stub, replay, import and model responses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.messages import answer_text, visible_answer
from curata.functions.text import compact_text, line_steps, loose_steps, truthy

# Names of kinds and modes, the statuses of fresh rows.
SFT, EVAL = "sft_sample", "eval_case"
MODES = {"stub": "teacher_runner_stub", "replay": "teacher_runner_replay", "import": "teacher_runner_import"}
FRESH = "teacher_generated"
RUBRIC = "struct<must_include:array<string>,must_not_include:array<string>,style:string,scoring_notes:string>"
RECORDS = "array<struct<doc_id:string,chunk_id:string,section_title:string,source_spans:array<string>>>"
JOB = f"""job_id string, wave_id string, product string, language string, task_type string, target_split string, expected_output_kind string, quality_score int, selection_reason string,
teacher_prompt_version string, behavior_spec_path string, prompt_template_path string, source_doc_ids array<string>, source_chunk_ids array<string>,
runner_input struct<system_message:string,user_message:string>,
fixture_payload struct<assistant_message:string,draft_answer:string,case_description:string,expected_behavior:string,reference_answer:string,rubric:{RUBRIC}>,
provenance struct<source_records:{RECORDS}>"""
RESPONSE = f"""job_id string, teacher_model string, teacher_provider string, teacher_run_id string, teacher_prompt_version string, generation_mode string,
parsed_response struct<answer:string,needs_clarification:boolean,clarification_question:string,escalate:boolean,uncertainty_reason:string,steps:array<string>,notes:array<string>,case_description:string,expected_behavior:string,reference_answer:string,rubric:{RUBRIC}>,
provenance struct<transform_pipeline_version:string,source_job_path:string,behavior_spec_path:string,prompt_template_path:string>"""


@dataclass(frozen=True)
class Run:
    model: str
    provider: str
    run_id: str
    version: str = "pipeline_v1"


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _origin(version: Column, spec: Column, template: Column, records: Column) -> Column:
    return F.struct(version.alias("transform_pipeline_version"), spec.alias("behavior_spec_path"), template.alias("prompt_template_path"), records.alias("source_records"))


def _candidate(is_eval: Column, who: dict[str, Column], asks: Column, answer: Column, clarify: Column, case: Column, behavior: Column, rubric: Column, origin: Column) -> Column:
    """One struct for both kinds; the fields of the other kind are null."""
    only = lambda yes, c: F.when(is_eval if yes else ~is_eval, c)
    notes = F.coalesce(rubric["scoring_notes"], F.lit(""))
    split = F.when(is_eval, "eval").otherwise("train")
    name = F.concat("job_id", F.lit("__candidate"))
    shared = {"product": F.col("product"), "language": F.col("language"), "task_type": F.col("task_type"), "source_doc_ids": F.col("source_doc_ids"), "source_chunk_ids": F.col("source_chunk_ids"), **who, "review_status": F.lit(FRESH), "split": split, "approved_by": F.lit(None).cast("string"), "promoted_from": F.lit(None).cast("string"), "provenance": origin}
    meta = F.struct(*(c.alias(k) for k, c in shared.items()), clarify.alias("needs_clarification"))
    return F.struct(
        only(False, name).alias("id"), only(True, name).alias("eval_id"), *(c.alias(k) for k, c in shared.items()), only(True, F.col("task_type")).alias("case_type"),
        only(False, F.array(_message("system", F.col("runner_input.system_message")), _message("user", asks), _message("assistant", answer))).alias("messages"),
        only(True, asks).alias("prompt"), only(True, case).alias("case_description"), only(True, behavior).alias("expected_behavior"), only(True, answer).alias("reference_answer"),
        only(True, rubric.withField("scoring_notes", notes)).alias("rubric"), only(False, meta).alias("meta"),
    )


def _outputs(j: DataFrame, who: dict[str, Column], candidate: Column, record_type: Column, version: Column, job_path: Column, raw_path: str | None) -> DataFrame:
    origin = F.struct(version.alias("transform_pipeline_version"), job_path.alias("source_job_path"), F.col("provenance.source_records").alias("source_records"))
    kept = [F.col(c) for c in ("wave_id", "target_split", "product", "language", "task_type", "source_doc_ids", "source_chunk_ids", "quality_score", "selection_reason")]
    return j.select(
        F.concat_ws("::", who["teacher_run_id"], "job_id").alias("output_id"), "job_id", record_type.alias("record_type"), *kept, *(c.alias(k) for k, c in who.items()), F.lit(FRESH).alias("review_status"),
        F.lit(None).cast("string").alias("approved_by"), F.lit(None).cast("string").alias("promoted_to"), F.lit(raw_path).cast("string").alias("raw_response_path"), candidate.alias("candidate"), origin.alias("provenance"),
    )


def from_fixtures(jobs: DataFrame, run: Run) -> DataFrame:
    """Outputs whose answers are the jobs' own fixtures; a job to train on without a draft is an error."""
    p, is_eval = F.col("fixture_payload"), F.col("expected_output_kind") != SFT
    draft = F.coalesce(truthy(p["assistant_message"]), truthy(p["draft_answer"]))
    checked = jobs.withColumn("_answer", F.when(is_eval, p["reference_answer"]).otherwise(F.coalesce(draft, F.raise_error(F.concat(F.lit("no draft answer for "), "job_id")).cast("string"))))
    who = {"teacher_provider": F.lit(run.provider), "teacher_model": F.lit(run.model), "teacher_run_id": F.lit(run.run_id), "teacher_prompt_version": F.col("teacher_prompt_version"), "generation_mode": F.lit(MODES["stub"])}
    origin = _origin(F.lit(run.version), F.col("behavior_spec_path"), F.col("prompt_template_path"), F.col("provenance.source_records"))
    made = _candidate(is_eval, who, F.col("runner_input.user_message"), F.col("_answer"), F.col("task_type") == "clarification", p["case_description"], p["expected_behavior"], p["rubric"], origin)
    return _outputs(checked, who, made, F.when(is_eval, EVAL).otherwise(SFT), F.lit(run.version), F.lit(""), None)


def from_replay(jobs: DataFrame, run: Run, recorded: DataFrame) -> DataFrame:
    """Outputs with the recorded candidates (job_id, record_type, candidate) as they are."""
    who = {"teacher_provider": F.lit(run.provider), "teacher_model": F.lit(run.model), "teacher_run_id": F.lit(run.run_id), "teacher_prompt_version": F.col("teacher_prompt_version"), "generation_mode": F.lit(MODES["replay"])}
    j = jobs.join(recorded.select("job_id", F.col("record_type").alias("_type"), F.col("candidate").alias("_candidate")), "job_id")
    return _outputs(j, who, F.col("_candidate"), F.col("_type"), F.lit(run.version), F.lit(""), None)


def from_responses(jobs: DataFrame, responses: DataFrame, run: Run, raw_path: str | None = None, simulated: DataFrame | None = None) -> DataFrame:
    """Outputs from parsed responses. What a response says of itself and its provenance goes before the job's.

    ``simulated`` (job_id, request_text, ..) are user simulations: their request is what the user asks,
    and the simulation travels with the output.
    """
    r = responses.select("job_id", *(F.col(c).alias(f"_{c}") for c in responses.columns if c != "job_id"))
    j = jobs.join(r, "job_id")
    asks = F.col("runner_input.user_message")
    if simulated is not None:
        j = j.join(simulated.select("job_id", F.struct(*(c for c in simulated.columns if c != "job_id")).alias("_simulated")), "job_id", "left")
        asks = F.coalesce(truthy(F.col("_simulated.request_text")), asks)
    p, origin, is_eval = F.col("_parsed_response"), F.col("_provenance"), F.col("expected_output_kind") != SFT
    who = {c: F.col(f"_{c}") for c in ("teacher_provider", "teacher_model", "teacher_run_id", "teacher_prompt_version", "generation_mode")}
    answer = visible_answer(F.col("task_type"), F.when(is_eval, F.coalesce(truthy(p["reference_answer"]), p["answer"])).otherwise(p["answer"]), p["steps"])
    version = F.coalesce(origin["transform_pipeline_version"], F.lit(run.version))
    own = _origin(version, F.coalesce(truthy(origin["behavior_spec_path"]), F.col("behavior_spec_path")), F.coalesce(truthy(origin["prompt_template_path"]), F.col("prompt_template_path")), F.col("provenance.source_records"))
    made = _candidate(is_eval, who, asks, answer, F.coalesce(p["needs_clarification"], F.lit(False)), p["case_description"], p["expected_behavior"], p["rubric"], own)
    if simulated is not None:
        made = made.withField("simulated_user", F.when(is_eval, F.col("_simulated"))).withField("meta", F.when(~is_eval, made["meta"].withField("simulated_user", F.col("_simulated"))))
    out = _outputs(j, who, made, F.when(is_eval, EVAL).otherwise(SFT), version, F.coalesce(truthy(origin["source_job_path"]), F.lit("")), raw_path)
    return out


def fixture_responses(jobs: DataFrame, run: Run, jobs_path: str) -> DataFrame:
    """Responses as a model would give them, from the jobs' fixtures: steps read from the answer, flags from the task."""
    p, is_eval, task = F.col("fixture_payload"), F.col("expected_output_kind") != SFT, F.col("task_type")
    answer = F.when(is_eval, p["reference_answer"]).otherwise(p["assistant_message"])
    return jobs.select("job_id", *_response(run, answer, task, loose_steps(answer), F.array(F.lit("fixture import path for teacher replay validation")), "Unsicherheit aus dokumentierter Evidenzgrenze abgeleitet.", is_eval, p, jobs_path, "teacher_fixture_import", F.col("behavior_spec_path"), F.col("prompt_template_path")))


def reviewed_responses(outputs: DataFrame, run: Run, jobs_path: str) -> DataFrame:
    """Responses from outputs that a person approved: the way back from a candidate to what a model would have said."""
    c, is_eval, task = F.col("candidate"), F.col("record_type") != SFT, F.col("task_type")
    rows = outputs.where((F.col("review_status") == "human_reviewed") & truthy(F.col("approved_by")).isNotNull())
    answer = F.trim(F.when(is_eval, c["reference_answer"]).otherwise(answer_text(F.lit(None).cast("string"), c["messages"])))
    steps = F.when(task == "step_by_step", line_steps(answer)).otherwise(F.array().cast("array<string>"))
    title = F.coalesce(F.get(F.col("provenance.source_records"), F.lit(0))["section_title"], F.lit("Unbekannter Abschnitt"))
    # fixed values: the notes' and the reason's wording
    notes = F.array(F.concat(F.when(is_eval, "Eval-Referenz").otherwise("Supportantwort"), F.lit(" aus dem Abschnitt "), title, F.lit(".")), F.concat(F.lit("Codex-kuratierte Wave1-Antwort fuer "), task, F.lit(".")))
    reason = "Die Quelle belegt nur den beschriebenen Kontext und keine allgemeine Zusage."
    return rows.select("job_id", *_response(run, answer, task, steps, notes, reason, is_eval, c, jobs_path, "teacher_response_materialized", c["provenance"]["behavior_spec_path"], c["provenance"]["prompt_template_path"]))


def _response(run: Run, answer: Column, task: Column, steps: Column, notes: Column, reason: str, is_eval: Column, more: Column, jobs_path: str, mode: str, spec: Column, template: Column) -> list[Column]:
    none = F.lit(None).cast("string")
    clarify, unsure = task == "clarification", task == "uncertainty_escalation"
    parsed = F.struct(
        answer.alias("answer"), clarify.alias("needs_clarification"), F.when(clarify, answer).otherwise(none).alias("clarification_question"), unsure.alias("escalate"), F.when(unsure, reason).otherwise(none).alias("uncertainty_reason"),
        steps.alias("steps"), notes.alias("notes"), *(F.when(is_eval, more[k]).alias(k) for k in ("case_description", "expected_behavior", "reference_answer", "rubric")),
    )
    who = {"teacher_model": run.model, "teacher_provider": run.provider, "teacher_run_id": run.run_id}
    origin = F.struct(F.lit(run.version).alias("transform_pipeline_version"), F.lit(jobs_path.replace("\\", "/")).alias("source_job_path"), spec.alias("behavior_spec_path"), template.alias("prompt_template_path"))
    return [*(F.lit(v).alias(k) for k, v in who.items()), F.col("teacher_prompt_version"), F.lit(mode).alias("generation_mode"), parsed.alias("parsed_response"), origin.alias("provenance")]


def judged_text(record_type: Column, candidate: Column) -> Column:
    """What a judge reads of an output: the last answer or the reference, compacted."""
    last = F.try_element_at(F.filter(candidate["messages"], lambda m: m["role"] == "assistant"), F.lit(-1))["content"]
    return compact_text(F.coalesce(F.when(record_type == SFT, last).otherwise(candidate["reference_answer"]), F.lit("")))


# What an answer of each task must be like.
CONTRACTS = {
    "clarification": "needs_clarification=true; clarification_question genau eine fokussierte Rueckfrage; answer nur diese Rueckfrage und mit '?'; escalate=false; steps=[]",
    "uncertainty_escalation": "escalate=true; uncertainty_reason kurz nennen; Antwort muss Evidenzgrenze sichtbar machen; needs_clarification=false",
    "step_by_step": "steps nur mit echten Schritten aus der Quelle fuellen; genau eine konsolidierte Prozedur; keine doppelte Ausgabe; bei benachbarten Teilzielen genau einen durchgaengigen Ablauf waehlen; keine Vermischung getrennter Verfahren; Reihenfolge eindeutig; bis zum eigentlichen Zielzustand inklusive letztem zielerreichenden Schritt zu Ende fuehren; answer hoechstens als kurze Einleitung, keine nummerierten oder aufgelisteten Schritte in answer",
    "troubleshooting": "symptombezogen antworten; dokumentierte Bedingung, Pruefung oder Abhilfe klar benennen",
}
CONTRACT_ELSE = "direkte, dokumentationsgebundene Antwort ohne unnoetige Vorrede"


def contract(task: Column) -> Column:
    """The contract of a task, for its prompt."""
    return F.coalesce(*(F.when(task == k, v) for k, v in CONTRACTS.items()), F.lit(CONTRACT_ELSE))


_FILLED = {"type": "string", "minLength": 1}
_MAYBE = {"type": ["string", "null"]}
_STRINGS = {"type": "array", "items": {"type": "string"}}
_FILLED_STRINGS = {"type": "array", "items": _FILLED}


def _closed(properties: dict) -> dict:
    return {"type": "object", "additionalProperties": False, "required": list(properties), "properties": properties}


def answer_schema(kind: str, tasks: Sequence[str], job_ids: Sequence[str] | None = None) -> dict:
    """The JSON Schema of one response, or of a batch of responses to the jobs named."""
    fields = {"answer": _FILLED, "task_type": {"type": "string", "enum": sorted(set(tasks))}, "needs_clarification": {"type": "boolean"}, "clarification_question": _MAYBE, "escalate": {"type": "boolean"}, "uncertainty_reason": _MAYBE, "steps": _FILLED_STRINGS, "source_chunk_ids": _FILLED_STRINGS | {"minItems": 1}, "notes": _STRINGS}
    if kind == EVAL:
        fields |= dict.fromkeys(("case_description", "expected_behavior", "reference_answer"), _FILLED) | {"rubric": _closed({"must_include": _STRINGS, "must_not_include": _STRINGS, "style": _FILLED, "scoring_notes": _MAYBE})}
    return _closed(fields) if job_ids is None else batch_schema(fields, job_ids)


def judge_schema(job_ids: Sequence[str]) -> dict:
    """The JSON Schema of a batch of judgements."""
    return batch_schema({"decision": {"type": "string", "enum": ["approve", "reject"]}, "quality_score": {"type": "integer", "minimum": 0, "maximum": 100}, "summary": _FILLED, "blocking_reasons": _STRINGS, "strengths": _STRINGS}, job_ids)


def simulation_schema(job_ids: Sequence[str]) -> dict:
    """The JSON Schema of a batch of simulated users."""
    return batch_schema(dict.fromkeys(("request_text", "difficulty", "phrasing_style", "user_goal", "scenario_summary"), _FILLED), job_ids)


def batch_schema(fields: dict, job_ids: Sequence[str]) -> dict:
    """A batch answers each job once."""
    item = _closed({"job_id": {"type": "string", "enum": list(job_ids)}} | fields)
    return _closed({"items": {"type": "array", "minItems": len(job_ids), "maxItems": len(job_ids), "items": item}})
