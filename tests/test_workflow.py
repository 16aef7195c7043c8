"""The stages of a run from jobs to gold rows, and saving rows."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from curata.operators import materialize, stages, workflow
from curata.plans import runs as run_plans

SF = "/root/testdata/sf0.001"
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have the tests


class Says:
    """A client that answers each request with what ``make`` gives for its prompt."""

    def __init__(self, make):
        self.make = make

    def complete(self, requests):
        return [{"id": r["id"], "text": json.dumps(self.make(r))} for r in requests]


def _user(r):
    return {"request_text": "please " + r["id"], "difficulty": "easy", "phrasing_style": "short", "user_goal": "g", "scenario_summary": "s"}


def _answer(r):
    task = r["prompt"].split("task_type: ")[1].split("\n")[0]
    clarify, unsure = task == "clarification", task == "uncertainty_escalation"
    text = "Which one?" if clarify else "Cut off..." if r["id"].endswith("7") else "An answer."
    return {"answer": text, "reference_answer": text, "needs_clarification": clarify and not r["id"].endswith("2"), "clarification_question": text if clarify else None, "escalate": unsure, "uncertainty_reason": "why" if unsure else None, "steps": ["a", "b"], "notes": []}


def _judge(r):
    return {"decision": "reject" if r["id"].endswith("5") else "approve", "quality_score": 6 if r["id"].endswith("4") else 9, "summary": "ok", "blocking_reasons": ["bad"] if r["id"].endswith("5") else []}


def test_a_run_from_jobs_to_gold(spark):
    jobs = run_plans.jobs(spark, SF).drop("doc_id").where("task_type <> 'step_by_step'").limit(40).cache()
    clients = {"user_simulation": lambda: Says(_user), "answer": lambda: Says(_answer), "judge": lambda: Says(_judge)}
    out = workflow.run(jobs, clients, run_plans.RUN, 4, promote=True)
    rows = {r.job_id: r for r in out["reviewed"].collect()}
    assert len(rows) == 40
    for i, r in rows.items():
        bad = i.endswith(("5", "4")) or (i.endswith("7") and r.task_type != "clarification") or (i.endswith("2") and r.task_type == "clarification")
        assert (r.review_status == "rejected") == bad == (r.auto_review.decision == "reject"), (i, r.task_type, r.auto_review)
        assert r.candidate.review_status == r.review_status and (r.candidate.prompt or r.candidate.messages[1].content) == "please " + i
        assert r.auto_review.quality_score == (60 if i.endswith("4") else 90)
    gold_rows = out["gold"].collect()
    assert len(gold_rows) == sum(r.review_status == "codex_reviewed" for r in rows.values()) and all(g.candidate.review_status == "promoted" for g in gold_rows)
    health = {r.stage: r for r in workflow.stage_health({s: out[f"{s}_responses"] for s in clients}).collect()}
    assert all(h.completed_jobs == 40 and h.executed_batches == 10 for h in health.values())
    # a stage that was answered before isn't asked again
    done = out["user_simulation_responses"].select("job_id", "text")
    again = workflow.run(jobs, clients | {"user_simulation": lambda: Says(lambda r: 1 / 0)}, run_plans.RUN, 4, done={"user_simulation": done})
    assert again["user_simulations"].count() == 40
    # what isn't of the schema fails its row only
    odd = workflow.run(jobs.limit(8), clients | {"answer": lambda: Says(lambda r: 5 if r["id"].endswith("1") else _answer(r))}, run_plans.RUN, 4)
    assert odd["outputs"].count() == sum(not r.job_id.endswith("1") for r in jobs.limit(8).collect())


def test_pre_gold_needs_answers(spark):
    r = run_plans._reviewed(spark, SF)
    with pytest.raises(ValueError, match="no approved rows"):
        workflow.pre_gold(r.withColumn("review_status", F.lit("rejected")), "p")
    with pytest.raises(ValueError, match="no answer to export"):
        blank = F.col("candidate").withField("messages", F.array(F.struct(F.lit("assistant").alias("role"), F.lit(" ").alias("content"))))
        workflow.pre_gold(r.withColumn("candidate", blank), "p")


def test_saving_rows(spark, tmp_path):
    rows = spark.createDataFrame([("o1", "human_reviewed"), ("o2", None)], "output_id string, review_status string")
    none = rows.limit(0).select("output_id", F.lit("x").alias("reason"))
    target = f"{tmp_path}/r.jsonl"
    seen = workflow.save(rows, target, None, none)
    with pytest.raises(ValueError, match="changed meanwhile"):
        workflow.save(rows, target, "0:0", none)
    back = spark.read.schema(rows.schema).json(target)
    assert workflow.save(back.where("output_id = 'o1'"), target, seen, none) != seen and spark.read.json(target).count() == 1
    with pytest.raises(ValueError, match="'o1', 'bad'"):
        workflow.save(rows, target, seen, spark.createDataFrame([("o1", "bad")], "output_id string, reason string"))
    with pytest.raises(ValueError, match="on purpose"):
        workflow.save(rows, "data/gold/train/x.jsonl", None, none)
    p = workflow.payload(rows, "data/gold/eval/x.jsonl", none)
    assert p["kind"] == "gold_eval" and p["editable"] and p["status_counts"] == {"human_reviewed": 1, "<none>": 1} and p["faults"] == []
    full = rows.withColumns({"record_type": F.lit("sft_sample"), "source_chunk_ids": F.array(F.lit("c"))})
    reasons = lambda *paths: {r.reason for r in workflow.promotion_export_faults(full, *paths).collect()}
    assert reasons("a", "b", "c") == {"source is no reviewed file", "no file of gold train", "no file of gold eval"}
    assert reasons("data/derived/teacher_outputs/a_reviewed_teacher_outputs.jsonl", "data/gold/train/b.jsonl", "data/gold/eval/c.jsonl") == set()


def test_program_as_client(tmp_path):
    code = "import json,sys; r=json.load(sys.stdin); open(sys.argv[1],'w').write(json.dumps({'items':[{'id':x['id'],'text':'t'} for x in r]}))"
    assert stages.client("cli", command=[sys.executable, "-c", code, "{out}"]).complete([{"id": "a"}]) == [{"id": "a", "text": "t"}]
    assert stages.Cli([sys.executable, "-c", "print('{\"items\": []}')"]).complete([]) == []
    with pytest.raises(RuntimeError, match="after 2 attempts"):
        stages.Cli([sys.executable, "-c", "print(1)"], attempts=2).complete([])


def test_seed_rows(spark):
    a, b = workflow.seed_rows(run_plans.jobs(spark, SF))
    assert a.count() + b.count() == run_plans.jobs(spark, SF).count() and a.orderBy("id").first().id == "sft_0001"
    assert materialize.SFT == "sft_sample"


def test_seed_numbers_beyond_four_digits(spark, tmp_path):
    """Ids of more than 9,999 rows are whole, all different and the SQL's."""
    import duckdb

    spark.range(12_500).selectExpr("id as doc_id", "1 as quality", "0 as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW labels AS SELECT * FROM '{tmp_path}/labels.parquet/*.parquet'")
    rel = con.sql(run_plans.ORACLES["seed_samples"])
    got = [tuple(r[c] for c in rel.columns) for r in run_plans.seed_samples(spark, str(tmp_path)).collect()]
    assert len({r[0] for r in got}) == 12_500 and any(r[0] == "sft_10000" for r in got)
    assert sorted(got) == sorted(rel.fetchall())
