"""Materialisation, gold rows, audits and training data on small fixtures."""

import pytest
from pyspark.sql import functions as F

from curata.functions import text as tx
from curata.operators import audits, cards, gold, materialize, training, validate
from curata.plans import runs as run_plans

SF = "/root/testdata/sf0.001"


def one(spark, col, **v):
    return spark.createDataFrame([tuple(v.values())], list(v)).select(col.alias("r")).first().r


def test_text_additions(spark):
    assert one(spark, tx.compact_text(F.col("t")), t="  a \r\n\n\n\n b\t\n") == "a\n\nb"
    assert one(spark, tx.safe_slug(F.col("t")), t="ä b/c.d-e") == "ä_b_c.d-e" and one(spark, tx.ascii_slug(F.col("t")), t="ä b//c") == "_b_c"
    assert one(spark, tx.line_steps(F.col("t")), t="x\n 1. a \n2.b\n3.  c") == ["a", "c"]
    assert one(spark, tx.loose_steps(F.col("t")), t="x\n 1. a \n2.b\n3.  c\n4.") == ["a", "b", "c"]
    assert one(spark, tx.distinct_by_lower(F.col("t"), 3), t=["A", "b", "a", "B", "c", "d"]) == ["A", "b", "c"]
    first = lambda s, n: one(spark, tx.first_distinct_sentences(F.col("t"), F.col("s"), n), t="Eins gilt. Zwei gilt. eins gilt. Drei gilt:", s=s)
    assert first("Eins", 5) == ["Eins gilt.", "Zwei gilt."] and first("Anderes", 2) == ["Anderes", "Eins gilt."]
    assert one(spark, tx.support_sentences(F.col("t")), t="Gut. Hinweis: weg. | a | weg. Auch gut.") == ["Gut.", "Auch gut."]


def test_responses_become_outputs(spark):
    j = run_plans.jobs(spark, SF).drop("doc_id")
    r = run_plans.responses(run_plans.jobs(spark, SF))
    simulated = j.limit(5).select("job_id", F.lit("please").alias("request_text"), F.lit("easy").alias("difficulty"))
    out = materialize.from_responses(j, r, run_plans.RUN, "raw.jsonl", simulated)
    rows = out.collect()
    assert len(rows) == j.count() and all(x.raw_response_path == "raw.jsonl" and x.review_status == "teacher_generated" for x in rows)
    asked = [x for x in rows if (x.candidate.prompt or (x.candidate.messages and x.candidate.messages[1].content)) == "please"]
    assert len(asked) == 5 and all((x.candidate.simulated_user or x.candidate.meta.simulated_user).difficulty == "easy" for x in asked)
    for x in rows:
        assert (x.candidate.meta is None) == (x.record_type == "eval_case") == (x.candidate.id is None)
    recorded = out.select("job_id", "record_type", "candidate").limit(3)
    replayed = materialize.from_replay(j, run_plans.RUN, recorded)
    assert replayed.count() == 3 and replayed.first().generation_mode == "teacher_runner_replay"
    back = materialize.reviewed_responses(out.withColumns({"review_status": F.lit("human_reviewed"), "approved_by": F.lit("me")}), run_plans.RUN, "j.jsonl")
    assert back.count() == len(rows) and materialize.reviewed_responses(out, run_plans.RUN, "j").count() == 0
    bare = j.where("expected_output_kind = 'sft_sample'").withColumn("fixture_payload", F.col("fixture_payload").withField("assistant_message", F.lit(None).cast("string")).withField("draft_answer", F.lit("")))
    with pytest.raises(Exception, match="no draft answer"):
        materialize.from_fixtures(bare, run_plans.RUN).select("candidate").collect()


def test_response_schemas(spark):
    one_ = materialize.answer_schema("sft_sample", ["faq"])
    assert "rubric" not in one_["properties"] and one_["required"] == list(one_["properties"]) and len(one_["required"]) == 9
    many = materialize.answer_schema("eval_case", ["b", "a", "a"], ["j1", "j2"])["properties"]["items"]
    assert many["minItems"] == many["maxItems"] == 2 and many["items"]["properties"]["job_id"]["enum"] == ["j1", "j2"] and many["items"]["properties"]["task_type"]["enum"] == ["a", "b"]
    rows = spark.createDataFrame([("j1", "approve", 200, "s"), ("j9", "reject", 5, "")], "job_id string, decision string, quality_score int, summary string")
    item = materialize.judge_schema(["j1"])["properties"]["items"]["items"]
    bad = {(r.job_id, r.reason) for r in validate.schema_violations(rows, item, "job_id").collect()}
    assert {("j1", "quality_score: beyond maximum"), ("j9", "job_id: not in enum"), ("j9", "summary: too short")} <= bad
    assert set(materialize.simulation_schema(["x"])["properties"]["items"]["items"]["required"]) == {"job_id", "request_text", "difficulty", "phrasing_style", "user_goal", "scenario_summary"}


def test_gold_rows_and_checks(spark):
    o = run_plans.outputs(spark, SF).withColumns({"review_status": F.lit("human_reviewed"), "approved_by": F.lit("me")})
    p = gold.promoted(o, "a\\b.jsonl").collect()
    assert all(r.candidate.review_status == "promoted" and r.candidate.promoted_from.teacher_output_path == "a/b.jsonl" and (r.candidate.meta is None or r.candidate.meta.promoted_from.output_id == r.output_id) for r in p)
    assert gold.promotion_faults(o).count() == 0 and gold.promotion_faults(o.limit(0)).first().reason == "nothing to promote"
    flat = spark.createDataFrame([("promoted", "me", "train", [("user", "q")], ("seed", None, None))], "review_status string, approved_by string, split string, messages array<struct<role:string,content:string>>, meta struct<review_status:string,approved_by:string,split:string>")
    assert tuple(gold.propagate_status(flat).first().meta) == ("promoted", "me", "train")
    assert gold.with_status(flat.withColumn("review_status", F.lit("x")), "seed").count() == 1
    schema = {"required": ["output_id"], "properties": {"output_id": {"type": "string", "minLength": 3}}}
    assert gold.row_faults(o, "output_id", schema, {"eval_case": {"properties": {"prompt": {"type": "string", "minLength": 900}}}}).select("reason").distinct().collect()[0].reason == "candidate prompt: too short"
    ok = gold.post_checks(o, "output_id", schema).first()
    assert ok.schema_ok and ok.provenance_ok and gold.post_checks(o.limit(0), "output_id", schema).first().rows == 0
    reasons = {r.reason for r in gold.review_export_faults(o.withColumn("review_status", F.lit("seed")), "x/y.jsonl", "data/gold/train/z.jsonl").collect()}
    assert reasons == {"source is no output file", "target is no reviewed file", "no decisions"}
    paths = ["data/derived/teacher_outputs/a_raw_responses.jsonl", "data/derived/teacher_outputs/a_reviewed_teacher_outputs.jsonl", "data/derived/teacher_outputs/a_teacher_outputs.jsonl", "data/derived/teacher_outputs/a.jsonl", "data/gold/eval/b.jsonl", "data/gold/eval/b.json", "x.jsonl"]
    kinds = spark.createDataFrame([(x,) for x in paths], "p string").select("p", gold.path_kind(F.col("p")).alias("k"), gold.review_path(F.col("p")).alias("r")).collect()
    assert [k.k for k in kinds] == ["raw_responses", "reviewed_teacher_outputs", "teacher_outputs", "teacher_preview", "gold_eval", None, None]
    assert kinds[2].r.endswith("a_reviewed_teacher_outputs.jsonl") and kinds[1].r == paths[1] and kinds[3].r.endswith("a_reviewed.jsonl")
    assert gold.inside("/r", "a/../b") == "/r/b"
    with pytest.raises(ValueError, match="leads out"):
        gold.inside("/r", "../x")
    counts = gold.derivation_counts(run_plans._reviewed(spark, SF))
    page = gold.notes("Gold", counts)
    assert page.startswith("# Gold\n") and "## Approved" in page
    twice = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n long")
    assert [r.n for r in gold.duplicate_rows(twice, "k", order="n").collect()] == [2]


def test_classes_of_disagreement(spark):
    def runs(*rows):
        made = {}
        for i, n in enumerate(["reference", "v1", "v2", "v3"]):
            judged = [(k, "faq", r[i][0], r[i][1]) for k, r in enumerate(rows)]
            made[n] = (spark.createDataFrame(judged, "job_id long, task_type string, decision string, quality_score long"), spark.createDataFrame([(k, "faq", r[i][2]) for k, r in enumerate(rows)], "job_id long, task_type string, answer string"))
        return made

    a, r = "approve", "reject"
    b = audits.borderline(runs(
        [(a, 90, "x"), (a, 90, "x"), (r, 70, "x"), (a, 90, "x")],
        [(a, 90, "x"), (a, 90, "x"), (r, 70, "y"), (a, 90, "x")],
        [(None, 90, "x"), (a, 90, "x"), (a, 90, "x"), (a, 90, "x")],
        [(a, 90, "x"), (None, None, "x"), (None, None, "x"), (None, None, "x")],
        [(r, 50, "x"), (a, 95, "y"), (a, 95, "y"), (a, 95, "y")],
        [(r, 50, "x"), (a, 95, "x"), (a, 95, "x"), (a, 95, "x")],
        [(a, 65, "x"), (a, 95, "x"), (a, 95, "x"), (a, 95, "x")],
        [(a, 95, "x"), (a, 95, "x"), (a, 95, "x"), (a, 95, "x")],
    ), ["faq"], per_task=8)
    got = {x.job_id: (x.hint, x.tags) for x in b.collect()}
    assert [got[i][0] for i in range(8)] == ["same_answer_judge_instability", "answer_and_judge_shift", "insufficient_codex_reference", "missing_openrouter_signal", "answer_quality_gain_or_loss", "judge_calibration_conflict", "reasoning_drift_same_decision", "stable_borderline"]
    assert got[7][1] == ["focus_task_type:faq", "task_coverage_backfill"] and "decision_mismatch_vs_codex:v2" in got[0][1]
    c = audits.clarification(runs([(a, 1, "x"), (a, 1, "x"), (a, 1, "x"), (r, 1, "x")], [(r, 1, "x"), (a, 1, "x"), (a, 1, "x"), (a, 1, "x")], [(a, 1, "x"), (a, 1, "x"), (r, 1, "x"), (a, 1, "x")], [(a, 1, "x")] * 4), "faq")
    assert [x.hint for x in c.orderBy("job_id").collect()] == ["v3_outlier", "systematic_openrouter_disagreement", "mixed_signal", "stable_alignment"]


def test_benchmarks_and_stages(spark):
    ref, cand = {"name": "b", "role": "reference"}, {"name": "b", "role": "candidate"}
    assert audits.benchmark_name(ref, cand) == "b"
    for x, y, what in ((None, cand, "no benchmark"), (cand, cand, "plays the role"), (ref, {"name": "c", "role": "candidate"}, "two benchmarks")):
        with pytest.raises(ValueError, match=what):
            audits.benchmark_name(x, y)
    assert audits.benchmark_of(None, None, None) is None and audits.benchmark_of("b", "reference", "p")["profile_set"] == "p"
    for args, what in ((("b", None, "p"), "name and a role"), (("b", "r", None), "profile set"), (("b", "r", "p", True), "promotes nothing")):
        with pytest.raises(ValueError, match=what):
            audits.benchmark_of(*args)
    schema = "stage string, selected_jobs long, completed_jobs long, failed_jobs long, total_elapsed_ms long, total_retry_attempts long"
    d = audits.stage_deltas(spark.createDataFrame([("answer", 9, 8, 1, 100, None), ("judge", 1, 1, 0, 5, 0)], schema), spark.createDataFrame([("answer", 9, 9, 0, 40, 2)], schema))
    rows = {r.stage: r for r in d.collect()}
    assert rows["answer"].completed_jobs_delta == 1 and rows["answer"].total_retry_attempts_delta is None and rows["answer"].same_jobs and not rows["judge"].same_jobs
    with pytest.raises(ValueError, match="missing jobs: 2"):
        audits.run_delta(*(spark.createDataFrame([(i, "t", "a", 1) for i in ids], "job_id long, task_type string, decision string, quality_score long") for ids in ((1, 2), (1,))))


def test_training_rows_and_freeze(spark):
    chats = spark.createDataFrame([("a", [("user", "hi"), ("assistant", "yes")]), ("b", [("user", "x" * 30), ("assistant", "no")])], "id string, messages array<struct<role:string,content:string>>")
    letters = lambda: lambda texts: [[ord(c) for c in t] for t in texts]
    rows = {r.id: r for r in training.training_rows(chats, letters, 500).collect()}
    a = rows["a"]
    assert "".join(map(chr, a.input_ids)) == "<|user|>\nhi\n<|assistant|>\nyes\n" and a.labels[: a.n_prompt] == [-100] * a.n_prompt and "".join(map(chr, a.labels[a.n_prompt :])) == "yes\n"
    with pytest.raises(Exception, match="no token of its answer"):
        training.training_rows(chats, letters, 30).collect()
    s = training.token_stats(training.training_rows(chats, letters, 30, answers_only=False)).first()
    assert s.rows == 2 and s.max == 30 and s.truncated == 1
    manifest = {"export_id": "final", "train_records": 2, "eval_records": 1, "digests": {"train": "d"}, "split_chunk_overlap": []}
    parts = {"train": chats, "train_metadata": chats, "eval": chats.limit(1), "eval_metadata": chats.limit(1)}
    assert training.freeze_faults(manifest, parts, {"train": "d"}, spark).count() == 0
    bad = training.freeze_faults(manifest | {"export_id": "Demo1", "eval_records": 5, "split_chunk_overlap": ["c"]}, parts | {"train_metadata": chats.limit(1)}, {"train": "e"}, spark)
    assert {r.reason for r in bad.collect()} == {"provisional name: Demo1", "train and its metadata differ in number", "manifest has another number of eval records", "digest of train differs", "splits share chunks"}
    assert one(spark, training.not_final(F.col("t")), t="my_Stub_set")
    training.gate(3, None)
    with pytest.raises(ValueError, match="3 flagged rows, 2 allowed"):
        training.gate(3, 2)
    assert training.run_paths("r", ["judge", "x/y.jsonl"], "d") == {"judge": "d/r_judge.jsonl", "x/y.jsonl": "x/y.jsonl"}
    with pytest.raises(ValueError, match="there already"):
        training.fresh_run(["a"], False)
    training.fresh_run(["a"], True)


def test_cards(spark):
    c = spark.createDataFrame([(1, "sec_0001", "T", "a\nb")], "doc_id long, section_id string, title string, content string")
    made = cards.simple_chunks(c)
    assert made.first().chunk_id == "1::chunk_0000" and made.first().summary == "a b"
    s = cards.samples(cards.task_cards(made), "sys").first()
    assert [m.role for m in s.messages] == ["system", "user", "assistant"] and s.source_chunk_ids == ["1::chunk_0000"]


def test_canonical_rows_need_a_whole_sidecar(spark):
    from curata.operators import quality

    rows = spark.createDataFrame([("a", "", ["x"], ("m",)), ("b", None, [], ("n",))], "id string, status string, docs array<string>, meta struct<status:string>")
    side = spark.createDataFrame([("a", "s", ["y"]), ("b", "", [])], "id string, status string, docs array<string>")
    got = {r.id: (r.status, r.docs) for r in quality.canonical(rows, side, "id", ["status"], ["docs"]).collect()}
    assert got == {"a": ("s", ["y"]), "b": ("n", None)}
    assert {r.id: r.status for r in quality.canonical(rows, None, "id", ["status"], ["docs"]).collect()} == {"a": "m", "b": "n"}
    with pytest.raises(ValueError, match="missing from the sidecar: b"):
        quality.canonical(rows, side.where("id = 'a'"), "id", ["status"], [])
    with pytest.raises(ValueError, match="repeated in the sidecar: a"):
        quality.canonical(rows, side.unionByName(side.where("id = 'a'")), "id", ["status"], [])


def test_faults_of_jobs_cases_and_tasks(spark):
    from curata.operators import consistency

    jobs = spark.createDataFrame([("j1", "train", "faq", ["c"], "seed", "seed"), ("j2", "train", "faq", ["c"], "seed", "odd"), ("j3", "eval", "faq", ["c"], "promoted", "promoted")], "job_id string, target_split string, task_type string, source_chunk_ids array<string>, job_status string, review_status string")
    assert {tuple(r) for r in consistency.job_faults(jobs).collect()} == {("j2", "unknown review status"), ("j2", "statuses differ"), ("j2", "repeated split, task and chunks")}
    cases = spark.createDataFrame([("e1", " ", "b", "promoted", (["r"],), ["c"]), ("e2", "p", None, "x", ([],), ["c"])], "eval_id string, prompt string, expected_behavior string, review_status string, provenance struct<source_records:array<string>>, source_chunk_ids array<string>")
    assert {tuple(r) for r in consistency.case_faults(cases).collect()} == {("e1", "empty prompt"), ("e2", "empty expected behaviour"), ("e2", "unknown status"), ("e2", "source records don't match chunks")}
    some = spark.createDataFrame([("clarification",), ("step_by_step",)], "task_type string")
    assert sorted(r.task for r in consistency.missing_tasks(some).collect()) == ["faq_direct_answer", "troubleshooting", "uncertainty_escalation"]
    links = spark.createDataFrame([("r", ["c1", "c2", "c9"], ["d1"])], "id string, source_chunk_ids array<string>, source_doc_ids array<string>")
    chunks = spark.createDataFrame([("c1", "d1"), ("c2", "d2")], "chunk_id string, doc_id string")
    assert {tuple(r) for r in consistency.link_faults(links, "id", chunks).collect()} == {("r", "chunk of another document"), ("r", "unknown chunk")}


def test_recipes_find_their_chunk(spark):
    c = spark.createDataFrame([("d", "T", "c1", 1, 1), ("d", "T", "c2", 2, 2), ("e", "T", "c3", 1, 3)], "doc string, section_title string, chunk_id string, chunk_index_in_section int, at int")
    r = lambda *rows: spark.createDataFrame(list(rows), "recipe_id string, doc string, section_title string, index int")
    assert {x.recipe_id: x.chunk_id for x in cards.recipe_matches(r(("a", "d", "T", None), ("b", "d", "T", 2), ("c", "e", "T", 1)), c, "at").collect()} == {"a": "c1", "b": "c2", "c": "c3"}
    with pytest.raises(Exception, match="no chunk for z"):
        cards.recipe_matches(r(("z", "d", "U", None)), c, "at").collect()
