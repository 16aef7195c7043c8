"""Stages, reviews, exports, checks and files."""

import pytest
from pyspark.sql import functions as F

from curata.operators import derive, review, search, stages, validate
from curata.plans import profiles
from curata.sources import jsonl
from curata.streaming import incremental


def test_files_round_trip(spark, tmp_path):
    rows = [("a", None, [1, 2]), ("b", "ü", [])]
    df = spark.createDataFrame(rows, "id string, t string, n array<long>")
    jsonl.write_jsonl(df, f"{tmp_path}/x", single=True)
    back = jsonl.read_jsonl(spark, f"{tmp_path}/x", df.schema, lineage=True)
    assert sorted((r.id, r.t, list(r.n)) for r in back.collect()) == [("a", None, [1, 2]), ("b", "ü", [])]
    assert '"t":null' in next((tmp_path / "x").glob("part-*")).read_text()
    assert jsonl.row_digest(df) == jsonl.row_digest(df.orderBy(F.desc("id")).repartition(3))
    (tmp_path / "bad.jsonl").write_text('{"id":"a"}\n{"id":\n')
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, f"{tmp_path}/bad.jsonl", "id string").collect()
    (tmp_path / "ids.txt").write_text(" a \n\nb\na\n")
    ids = jsonl.read_ids(spark, f"{tmp_path}/ids.txt")
    assert sorted(r.id for r in ids.collect()) == ["a", "b"]
    assert jsonl.only_ids(df, "id", ids.where("id = 'a'")).count() == 1
    with pytest.raises(ValueError, match="unknown ids: c"):
        jsonl.only_ids(df, "id", spark.createDataFrame([("c",)], "id string"))
    m = jsonl.file_manifest(spark, f"{tmp_path}/ids.txt").first()
    assert m.n_rows == 3 and len(m.sha256) == 64
    jsonl.write_json({"n": ["ü", None]}, f"{tmp_path}/m.json", spark)
    assert jsonl.read_json(spark, f"{tmp_path}/m.json") == {"n": ["ü", None]} and "\n  \"n\"" in (tmp_path / "m.json").read_text()
    jsonl.write_ids(df, "id", f"{tmp_path}/idlist")
    assert sorted(r.id for r in jsonl.read_ids(spark, f"{tmp_path}/idlist").collect()) == ["a", "b"]
    files = jsonl.text_files(spark, f"{tmp_path}/*.txt")
    assert jsonl.ingest(files, "P", "DE", "1").first().doc_id == "p_de_ids"


def _jobs(spark, n=10):
    rows = [(f"j{i:02d}", f"prompt {i}", f"draft {i}") for i in range(n)]
    return stages.with_batches(spark.createDataFrame(rows, "job_id string, prompt string, draft string"), 4)


def test_stage_runs_resumes_and_fails_by_batch(spark):
    jobs = _jobs(spark)
    out = {r.job_id: r for r in stages.run_stage(jobs, stages.Stub).collect()}
    assert len(out) == 10 and out["j03"].text == "draft 3" and all(r.failure is None for r in out.values())
    done = spark.createDataFrame([("j03", "old")], "job_id string, text string")
    again = {r.job_id: r.text for r in stages.run_stage(jobs, stages.Stub, done).collect()}
    assert len(again) == 10 and again["j03"] == "old"
    recorded = {f"j{i:02d}": "r" for i in range(10) if i != 5}
    replayed = stages.run_stage(jobs, lambda: stages.Replay(recorded)).collect()
    batch = {r.batch for r in replayed if r.job_id == "j05"}
    assert {r.job_id for r in replayed if r.failure} == {r.job_id for r in replayed if r.batch in batch}
    assert stages.stage_metrics(stages.run_stage(jobs, stages.Stub)).first().completed_jobs == 10
    with pytest.raises(ValueError, match="unknown client"):
        stages.client("nope")
    assert stages.response_items({"choices": [{"message": {"content": [{"text": '{"items":'}, {"text": "[1]}"}]}}]}) == [1]


def test_prompts_packets_and_messages(spark):
    df = spark.createDataFrame([("faq", "ask", None)], "task string, q string, n long")
    assert df.select(stages.render_prompt("Do it", ["be brief"], task=F.col("task"), n=F.col("n")).alias("p")).first().p == "Do it\n- be brief\ntask: faq\nn: "
    from curata.functions import messages as ms

    chat = spark.createDataFrame([([("user", " "), ("user", "q"), ("assistant", "a"), ("assistant", " ")],)], "m array<struct<role:string,content:string>>")
    r = chat.select(ms.first_filled(F.col("m"), "user").alias("f"), ms.joined(F.col("m"), "user").alias("j"), ms.last_of(F.col("m"), "assistant").alias("l"), ms.answer_text(F.lit(" "), F.col("m")).alias("a"), ms.first_true(F.lit(""), F.lit(None).cast("string"), F.lit("x")).alias("t")).first()
    assert (r.f, r.j, r.l, r.a, r.t) == ("q", " \nq", " ", "a", "x")
    rows = spark.createDataFrame([(f"o{i}", "train", "faq", i, "w " * 200) for i in range(30)], "output_id string, target_split string, task_type string, quality_score long, answer string")
    packet = search.review_packet(rows, 3).collect()
    assert [p.output_id for p in packet] == ["o29", "o28", "o27"] and len(packet[0].preview) == 220
    lines = spark.createDataFrame([(["a", "b", "c", "d"],)], "l array<string>").select(search.excerpt(F.col("l"), F.lit(2), F.lit(2), 1).alias("e")).first().e
    assert [tuple(x) for x in lines] == [(1, "a"), (2, "b"), (3, "c")]


def test_last_by_key_and_required(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, n long, v string")
    assert stages.last_by_key(df, "k", "n").first().v == "y"
    with pytest.raises(ValueError, match="missing answers: a"):
        stages.require_all(df, spark.createDataFrame([("b",)], "k string"), "k", "answers")


def test_gates(spark):
    df = spark.createDataFrame(
        [(1, "fine text", "approve", 90), (2, "fine text", "approve", 60), (3, "cut…", "approve", 90), (4, " ", "approve", 90), (5, "fine", "reject", 90)],
        "id long, answer string, decision string, score long",
    )
    got = {r.id: (r.final_decision, r.review_status, list(r.blocking_reasons)) for r in review.auto_review(df, "answer", "decision", "score").collect()}
    assert got[1] == ("approve", "codex_reviewed", [])
    assert got[2][2] == ["approve decision below minimum quality score threshold"] and got[2][0] == "reject"
    assert got[3][2] == ["contains ellipsis/truncation artifact"] and got[4][2] == ["missing candidate text"]
    assert got[5][1] == "rejected"
    tasks = spark.createDataFrame([("clarification", "Sagen Sie mehr.", None, "", None, None), ("faq_direct_answer", "x", True, None, True, None)], "t string, a string, n boolean, q string, e boolean, r string")
    reasons = [len(r.r) for r in tasks.select(review.alignment_reasons(*(F.col(c) for c in "tanqer")).alias("r")).collect()]
    assert reasons == [3, 2]
    assert [r.s for r in spark.createDataFrame([(7,), (10,), (70,)], "s long").select(review.normalize_score(F.col("s")).alias("s")).collect()] == [70, 100, 70]


def test_overlay_counts(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    b = spark.createDataFrame([(1, "z"), (3, "w")], "id long, v string")
    assert {r.id: r.state for r in review.overlay(a, b, "id", ["v"]).collect()} == {1: "conflict", 2: "missing", 3: "extra"}


def test_derivation_and_export(spark):
    schema = "id string, output_id string, review_status string, split string, auto_review struct<decision:string>, messages array<struct<role:string,content:string>>, source_doc_ids array<string>, source_chunk_ids array<string>"
    ms = [("user", "q"), ("assistant", "a")]
    rows = [("1", "o1", "codex_reviewed", "train", ("approve",), ms, ["d"], ["c1"]), ("2", "o2", "rejected", "train", ("approve",), ms[:1], ["d"], ["c2"]), ("3", "o3", None, "train", None, ms, ["e"], [])]
    df = spark.createDataFrame(rows, schema)
    good, rest = derive.approved(df)
    assert [r.id for r in good.collect()] == ["1"] and rest.count() == 2
    assert [r.id for r in derive.train_records(df).collect()] == ["1", "3"]
    with pytest.raises(ValueError, match="ids are listed"):
        derive.controlled_gold(df, spark.createDataFrame([("o1",), ("o9",)], "output_id string"))
    reasons = {(r.id, r.reason) for r in derive.split_violations(df, "id", "train").collect()}
    assert ("3", "no source chunks") in reasons and ("1", "not promoted") in reasons
    other = df.where("id = '1'")
    assert [r.chunk_id for r in derive.shared_chunks(df, other).collect()] == ["c1"]
    with pytest.raises(ValueError, match="leak"):
        derive.assert_empty(derive.shared_chunks(df, other), "leak")
    m = derive.manifest("e", df.where("id = '1'"), df.where("id = '2'"))
    assert m["train_rows"] == 1 and m["split_chunk_overlap"] == [] and m["n_docs"] == 1
    assert derive.metadata(df, "id", "train", "sft_train", "p").first().task_type is None
    cases = derive.sft_to_eval(df.where("id = '1'"))
    assert derive.eval_records(cases, "sys").first().messages[0].content == "sys"
    assert {r.doc_id: r.n for r in derive.doc_counts(df).collect()} == {"d": 2, "e": 1}


def test_schema_and_provenance(spark):
    schema = {
        "required": ["id", "score", "gone"],
        "properties": {
            "id": {"type": "string", "minLength": 2}, "score": {"type": "integer", "minimum": 0, "maximum": 100}, "gone": {"type": "string"}, "note": {"type": ["string", "null"]},
            "tags": {"type": "array", "minItems": 1, "items": {"type": "string", "enum": ["a", "b"]}}, "in": {"type": "object", "required": ["x"], "properties": {"x": {"type": "string"}}},
        },
    }
    df = spark.createDataFrame([("ab", 5, ["a"], ("v",)), ("c", 500, ["z"], (None,))], "id string, score long, tags array<string>, `in` struct<x:string>")
    got = {(r.id, r.reason) for r in validate.schema_violations(df, schema, "id").collect()}
    assert got == {("ab", "gone: required"), ("c", "gone: required"), ("c", "id: too short"), ("c", "score: beyond maximum"), ("c", "tags[]: not in enum"), ("c", "in.x: required")}
    rows = spark.createDataFrame([("1", "p", [], "s", ([],))], "eval_id string, prompt string, source_doc_ids array<string>, review_status string, provenance struct<source_records:array<string>>")
    assert validate.row_kind(rows.columns) == "eval"
    assert {r.reason for r in validate.provenance_violations(rows, "eval_id").collect()} == {"missing source_doc_ids", "missing provenance.source_records"}
    keys = spark.createDataFrame([("a", ["x"]), ("a", ["y"])], "k string, refs array<string>")
    assert validate.duplicate_keys(keys, "k").first().n == 2
    assert [r.x for r in validate.missing_references(keys, "refs", spark.createDataFrame([("x",)], "x string"), "x").collect()] == ["y"]
    assert {tuple(r) for r in validate.different_keys(keys, keys.where("refs[0] = 'x'"), "k").collect()} == {("a", "left")}


def test_search_and_decisions(spark):
    df = spark.createDataFrame([("1", "Alpha", "teacher_generated", "sft_sample"), ("2", None, "human_reviewed", "eval_case")], "id string, t string, review_status string, record_type string")
    assert [r.id for r in search.search(df, "ALPHA").collect()] == ["1"] and search.search(df, status="human_reviewed").count() == 1
    after = df.withColumn("t", F.lit("beta"))
    assert {r.id: list(r.fields) for r in search.changed_fields(df, after, "id").collect()} == {"1": ["t"], "2": ["t"]}
    c = search.review_context(df).first()
    assert (c.pending, c.decided, c.eligible_train, c.eligible_eval) == (1, 1, 0, 1)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    done = {r.id: (r.review_status, r.approved_by) for r in search.apply_decisions(df, "id", ids("1"), ids(), "me").collect()}
    assert done == {"1": ("human_reviewed", "me"), "2": ("human_reviewed", None)}
    with pytest.raises(ValueError, match="both"):
        search.apply_decisions(df, "id", ids("1"), ids("1"), "me")
    docs = spark.createDataFrame([("p", "a\nb\nc")], "path string, text string")
    spans = spark.createDataFrame([("p#L2-L9",), ("p#L1",), ("q#L1",), ("junk",)], "span string")
    assert {r.span: r.excerpt for r in search.read_span(spans, docs).collect()} == {"p#L2-L9": "b\nc", "p#L1": "a", "q#L1": "", "junk": ""}


def test_profiles():
    stage = {"profile_name": "p", "backend": "http", "model": "m", "batch_size": 4, "max_attempts": 2, "timeout_sec": 9, "http": {"api_base": "u", "api_key_env": "NO_SUCH_KEY"}}
    config = {"version": 1, "profile_sets": {"s": {"stages": dict.fromkeys(profiles.STAGES, stage)}}}
    assert profiles.resolve(config, "s")["judge"].batch_size == 4
    with pytest.raises(ValueError, match="environment lacks NO_SUCH_KEY"):
        profiles.resolve(config, "s", check_env=True)
    with pytest.raises(ValueError, match="t: stage judge isn.t configured"):
        profiles.resolve(config, "t")
    for change, text in ({"batch_size": 0}, "batch_size isn.t a count from 1"), ({"backend": "x"}, "isn.t one of cli, http"), ({"temperature": 3}, "from 0 to 2"), ({"http": {"api_base": "u", "api_key_env": "k", "provider_options": {"model": 1}}}, "options without"), ({"cli": {}}, "cli is foreign to http"), ({"model": None}, "model is missing"):
        with pytest.raises(ValueError, match=text):
            profiles.resolve({"version": 1, "profile_sets": {"s": {"stages": {"judge": stage | change}}}}, "s")


def test_profiles_to_runtime():
    stage = {"profile_name": "p", "backend": "http", "model": "m", "batch_size": 4, "max_attempts": 2, "timeout_sec": 9, "http": {"api_base": "u", "api_key_env": "K"}}
    config = {"version": 1, "profile_sets": {"s": {"stages": dict.fromkeys(profiles.STAGES, stage)}}}
    p = profiles.resolve(config, "s")["answer"]
    assert p.options["api_base"] == "u" and profiles.preflight(config, "s").count("\n") == 2
    assert profiles.runtime(p, {"model": None}, {}) == profiles.Runtime("chat_endpoint", "http_batch", "m", 4, 2, 9, "p")
    base = {"backend": "cli", "model": "d", "batch_size": 1, "max_attempts": 1, "timeout_sec": 5}
    assert profiles.runtime(None, {"model": "other"}, base).model == "other"
    with pytest.raises(ValueError, match="can.t be: model"):
        profiles.runtime(p, {"model": "x"}, {})
    with pytest.raises(ValueError, match="version 1"):
        profiles.resolve({"version": 2}, "s")
    with pytest.raises(ValueError, match="no stage is called"):
        profiles.resolve({"version": 1, "profile_sets": {"s": {"stages": {"x": stage}}}}, "s")


def test_stream_appends_each_key_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"job_id":"a"}\n{"job_id":"b"}\n{"job_id":"a"}\n')
    stream = lambda: incremental.stream_jsonl(spark, str(src), "job_id string")
    incremental.append_new(stream(), f"{tmp_path}/out", f"{tmp_path}/cp")
    (src / "2.json").write_text('{"job_id":"b"}\n{"job_id":"c"}\n')
    incremental.append_new(stream(), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert sorted(r.job_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "c"]
    left = incremental.resume(spark.createDataFrame([("a",), ("z",)], "job_id string"), spark.read.parquet(f"{tmp_path}/out"))
    assert [r.job_id for r in left.collect()] == ["z"]
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert incremental.windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()
