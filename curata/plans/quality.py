"""Consistency and quality of chat data over stand-ins made of ``labels``, ``documents`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators import consistency, quality
from curata.plans import runs
from curata.plans.dialogs import word_sql
from curata.plans.metrics import CONV_SQL, HASH_SQL, first_and_last
from curata.plans.runs import _h, _s
from curata.plans.selection import TASKS
from curata.session import table



def _spoil(tag: str, n: int, bad: Column, good: Column) -> Column:
    return F.when(_h(tag, n) == 0, bad).otherwise(good)


def response_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with spoiled fields against their jobs, by reason."""
    j = runs.jobs(spark, sf_dir)
    p, rubric = F.col("fixture_payload"), F.col("fixture_payload.rubric")
    none, other = F.lit(None).cast("string"), F.array(F.lit("other"))
    parsed = F.struct(
        _spoil("p1", 23, F.lit("x"), F.col("task_type")).alias("task_type"), _spoil("p2", 29, other, F.col("source_chunk_ids")).alias("source_chunk_ids"), _spoil("p3", 31, F.lit(""), F.lit("a")).alias("answer"), _spoil("p4", 9, none, p["reference_answer"]).alias("reference_answer"),
        F.struct(_spoil("p5", 8, F.lit(None).cast("array<string>"), rubric["must_include"]).alias("must_include"), rubric["must_not_include"].alias("must_not_include"), _spoil("p6", 7, F.lit(""), rubric["style"]).alias("style")).alias("rubric"),
    )
    r = j.select(
        _spoil("r1", 40, F.concat(F.lit("stray_"), F.col("doc_id").cast("string")), F.col("job_id")).alias("job_id"), F.lit("run7").alias("teacher_run_id"), _spoil("r2", 17, F.lit("?"), F.concat(F.lit("run7::"), "job_id")).alias("output_id"),
        _spoil("r3", 19, F.lit("note"), F.col("expected_output_kind")).alias("record_type"), _spoil("r4", 21, F.lit("test"), F.col("target_split")).alias("target_split"), _spoil("r5", 25, F.lit("x"), F.col("task_type")).alias("task_type"),
        _spoil("r6", 27, other, F.col("source_chunk_ids")).alias("source_chunk_ids"), _spoil("r7", 28, other, F.col("source_doc_ids")).alias("source_doc_ids"), _spoil("r8", 33, none, F.col("teacher_prompt_version")).alias("teacher_prompt_version"), parsed.alias("parsed_response"), "doc_id",
    )
    often = F.when(_h("again", 35) == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return consistency.response_faults(r.withColumn("_", F.explode(often)).drop("doc_id", "_"), j.drop("doc_id")).groupBy("reason").agg(F.count("*").alias("n"))


def chat_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chats with spoiled messages, metas and links, by reason."""
    labels = table(spark, sf_dir, "labels")
    ids = lambda p: F.array(F.concat(F.lit(p), F.col("doc_id").cast("string")))
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    whole = F.array(say("system", F.lit("s")), say("user", F.lit("u")), say("assistant", _spoil("blank", 13, F.lit("  "), F.lit("a"))))
    m = F.when(_h("short", 17) == 0, F.slice(whole, 1, 2)).when(_h("turned", 19) == 0, F.reverse(whole)).otherwise(whole)
    status = _spoil("status", 23, F.lit("odd"), F.lit("promoted"))
    meta = F.struct(_spoil("mc", 11, ids("x"), ids("c")).alias("source_chunk_ids"), _spoil("md", 12, ids("x"), ids("d")).alias("source_doc_ids"), _spoil("ms", 14, F.lit("seed"), status).alias("review_status"))
    rows = labels.select(F.col("doc_id").alias("id"), m.alias("messages"), meta.alias("meta"), ids("c").alias("source_chunk_ids"), ids("d").alias("source_doc_ids"), status.alias("review_status"), F.struct(_spoil("rec", 15, F.array().cast("array<string>"), F.array(F.lit("r"))).alias("source_records")).alias("provenance"))
    chunks = labels.where(_h("chunk", 18) > 0).select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("chunk_id"), _spoil("doc", 16, F.lit("elsewhere"), F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("doc_id"))
    return consistency.chat_faults(rows).unionByName(consistency.link_faults(rows, "id", chunks)).groupBy("reason").agg(F.count("*").alias("n"))


def output_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed outputs, some spoiled, against their jobs, by reason."""
    j = runs.jobs(spark, sf_dir)
    o = runs._reviewed(spark, sf_dir)
    c = F.col("candidate")
    run = _spoil("run", 20, F.lit("else"), F.col("teacher_run_id"))
    spoiled = o.withColumns({"target_split": _spoil("split", 22, F.lit("test"), F.col("target_split")), "teacher_provider": _spoil("prov", 24, F.lit(""), F.col("teacher_provider")), "candidate": c.withField("teacher_run_id", run)})
    return consistency.output_faults(spoiled, j.where(_h("nojob", 26) > 0)).groupBy("reason").agg(F.count("*").alias("n"))


def gold_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with lost, stray and repeated origins, by reason."""
    labels = table(spark, sf_dir, "labels")
    out = labels.where(_h("out", 12) > 0).select(F.concat(F.lit("o"), F.col("doc_id").cast("string")).alias("output_id"), F.when(_h("status", 3) > 0, "human_reviewed").otherwise("rejected").alias("review_status"))
    rows = labels.select(
        _spoil("twice", 30, F.lit("g"), F.concat(F.lit("g"), F.col("doc_id").cast("string"))).alias("id"), _spoil("state", 11, F.lit("seed"), F.lit("promoted")).alias("review_status"), F.array(F.floor(F.col("doc_id") / 3).cast("string")).alias("source_chunk_ids"),
        F.struct(_spoil("origin", 13, F.lit(None).cast("string"), F.concat(F.lit("o"), F.col("doc_id").cast("string"))).alias("output_id")).alias("promoted_from"),
    )
    return consistency.gold_faults(rows, out, "id").groupBy("reason").agg(F.count("*").alias("n"))


def export_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export with ids that lack their other half and chunks of both splits."""
    labels = table(spark, sf_dir, "labels")
    message = F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content")), F.struct(F.lit("assistant").alias("role"), _spoil("mute", 21, F.lit(" "), F.lit("a")).alias("content")))
    is_eval = _h("half", 5) == 0
    rows = lambda keep, tag: labels.where(keep & (_h(tag, 25) > 0)).select(F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("id"), message.alias("messages"), F.array(F.floor(F.col("doc_id") / 2).cast("string")).alias("source_chunk_ids"))
    both = is_eval | (_h("both", 40) == 0)
    return consistency.export_faults(rows(~is_eval, "t"), rows(both, "e"), rows(~is_eval, "tm"), rows(both, "em"), {"train_records": -1})


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First questions and last answers of conversations, with the document of the same number as source."""
    docs = table(spark, sf_dir, "documents").where(F.col("doc_id") % 5 > 0).select(F.col("doc_id").alias("id"), F.col("text").alias("source"))
    task = F.get(F.array(*map(F.lit, TASKS)), (F.col("id") % 5).cast("int"))
    c = first_and_last(spark, sf_dir).where("answer is not null").select(F.col("conv_id").alias("id"), "prompt", "answer")
    return c.join(docs, "id", "left").withColumn("task", task)


def faithfulness_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers against source and prompt: shares of words and flags."""
    return quality.faithfulness(_asked(spark, sf_dir)).withColumn("flags", F.array_join("flags", ","))


def faithfulness_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagged answers with the most flags and the answers of the least overlap."""
    return quality.worst(quality.faithfulness(_asked(spark, sf_dir))).select("list", "id", "task", "overlap_ratio", F.size("flags").cast("long").alias("n_flags"))


def phrase_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers made of stock phrases, by flag."""
    n = _h("phrase", 9)
    answer = F.coalesce(*(F.when(n == i, F.concat(F.lit(s), F.lit(" x"))) for i, s in enumerate(quality.STARTERS + quality.LEFTOVERS)), F.when(n == 7, "cut..."), F.lit("plain"))
    flags = quality.phrase_flags(answer, F.when(_h("model", 6) == 0, "My Stub").otherwise("real"), F.lit(None).cast("string"))
    return table(spark, sf_dir, "labels").select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def canonical_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their sidecar and their own meta, by what was taken from where."""
    labels = table(spark, sf_dir, "labels")
    pick = lambda tag, word: F.when(_h(tag, 3) == 0, word).when(_h(tag, 3) == 1, "")
    some = lambda tag, word: F.when(_h(tag, 2) == 0, F.array(F.lit(word))).otherwise(F.array().cast("array<string>"))
    rows = labels.select(F.col("doc_id").alias("id"), pick("own", "row").alias("status"), some("owns", "row").alias("docs"), F.struct(pick("meta", "meta").alias("status"), F.lit("m").alias("model"), some("metas", "meta").alias("docs")).alias("meta"))
    side = labels.select(F.col("doc_id").alias("id"), pick("side", "side").alias("status"), some("sides", "side").alias("docs"))
    c = quality.canonical(rows, side, "id", ["status", "model", "run"], ["docs"])
    return c.groupBy("status", "model", "run", F.array_join("docs", ",").alias("docs")).agg(F.count("*").alias("n"))


def judge_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve judgements to look at."""
    judged = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("job_id"), runs._task().alias("task_type"), F.when(_h("dec", 4) == 0, "reject").otherwise("approve").alias("decision"), F.when(_h("nos", 9) > 0, _h("sc", 101)).alias("quality_score"), F.when(_h("blk", 5) == 0, F.array(F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("blocking_reasons"),
    )
    return quality.focus_cases(judged).select("job_id", "task_type", "decision", F.col("score").cast("long").alias("score"), F.array_join("tags", ",").alias("tags"))


QUERIES = {f.__name__: f for f in (response_faults, chat_faults, output_faults, gold_faults, export_faults, faithfulness_audit, faithfulness_worst, phrase_flags, canonical_values, judge_focus)}


def _count(checks: dict[str, str], source: str) -> str:
    """Rows of a source by the reasons whose conditions hold."""
    listed = ", ".join(f"CASE WHEN {test} THEN '{name.replace(chr(39), chr(39) * 2)}' END" for name, test in checks.items())
    return f"SELECT reason, count(*) AS n FROM (SELECT unnest([{listed}]) AS reason FROM {source}) WHERE reason IS NOT NULL GROUP BY reason"


_Z = lambda tag, n: f"({_s(tag, n)} = 0)"
_EVAL = f"({HASH_SQL.format('doc_id::VARCHAR')} % 7 = 0)"
_KNOWN = f"NOT {_Z('r1', 40)}"
_CASE = f"{_KNOWN} AND {_EVAL} AND NOT {_Z('r3', 19)}"
_RESPONSE = {
    "unknown job": _Z("r1", 40), "output id isn't run and job": f"{_KNOWN} AND {_Z('r2', 17)}", "record_type differs": f"{_KNOWN} AND {_Z('r3', 19)}", "target_split differs": f"{_KNOWN} AND {_Z('r4', 21)}", "task_type differs": f"{_KNOWN} AND {_Z('r5', 25)}",
    "source_chunk_ids differs": f"{_KNOWN} AND {_Z('r6', 27)}", "source_doc_ids differs": f"{_KNOWN} AND {_Z('r7', 28)}", "teacher_prompt_version differs": f"{_KNOWN} AND {_Z('r8', 33)}", "parsed task differs": f"{_KNOWN} AND {_Z('p1', 23)}",
    "parsed chunks differ": f"{_KNOWN} AND {_Z('p2', 29)}", "no answer": f"{_KNOWN} AND {_Z('p3', 31)}", "no reference answer": f"{_CASE} AND {_Z('p4', 9)}", "no list of what must be in": f"{_CASE} AND {_Z('p5', 8)}", "no style": f"{_CASE} AND {_Z('p6', 7)}",
    "repeated job": f"twice = 1 AND {_Z('again', 35)}",
}
_SHORT, _TURNED, _BLANK = _Z("short", 17), f"(NOT {_Z('short', 17)} AND {_Z('turned', 19)})", _Z("blank", 13)
_CHAT = {
    "fewer than three messages": _SHORT, "first message isn't the system's": _TURNED, "last message isn't the assistant's": _TURNED, "empty answer": f"NOT {_SHORT} AND NOT {_TURNED} AND {_BLANK}", "chunks differ from meta": _Z("mc", 11), "documents differ from meta": _Z("md", 12),
    "status differs from meta": _Z("ms", 14), "unknown status": _Z("status", 23), "source records don't match chunks": _Z("rec", 15), "unknown chunk": _Z("chunk", 18), "chunk of another document": f"NOT {_Z('chunk', 18)} AND {_Z('doc', 16)}",
}
_THERE = f"NOT {_Z('nojob', 26)}"
_STATE = _s("status", 4)
_OUTPUT = {
    "unknown job": _Z("nojob", 26), "split differs from job": f"{_THERE} AND {_Z('split', 22)}", "no provider": f"{_THERE} AND {_Z('prov', 24)}", "candidate has another provider": f"{_THERE} AND {_Z('prov', 24)}", "candidate has another run": f"{_THERE} AND {_Z('run', 20)}",
    "candidate has another status": f"{_THERE} AND {_STATE} < 3", "reviewed without a name": f"{_THERE} AND ({_STATE} = 2 OR ({_STATE} < 2 AND {_Z('name', 5)}))",
    "approved with artifacts": f"{_THERE} AND {_STATE} IN (0, 2) AND answer = ''",
}
_ORIGIN, _OUT = f"NOT {_Z('origin', 13)}", f"NOT {_Z('out', 12)}"
_GOLD = {"not promoted": _Z("state", 11), "no origin": _Z("origin", 13), "unknown origin": f"{_ORIGIN} AND {_Z('out', 12)}", "origin wasn't approved": f"{_ORIGIN} AND {_OUT} AND {_Z('status', 3)}", "repeated id": "first_twice AND n_twice > 1", "chunk used twice": "n_chunk > 1"}
_ASKED = f"""{CONV_SQL},
q AS (SELECT conv_id AS id, prompt, answer, d.text AS source, ['{"', '".join(TASKS)}'][(conv_id % 5)::INT + 1] AS task FROM c LEFT JOIN (SELECT * FROM documents WHERE doc_id % 5 > 0) d ON d.doc_id = c.conv_id WHERE answer IS NOT NULL),
w AS (SELECT *, {word_sql('answer')} AS a, {word_sql('source')} AS s, {word_sql('prompt')} AS p FROM q),
r AS (SELECT *, len(list_filter(a, lambda x: list_contains(s, x))) / greatest(len(a), 1) AS overlap, len(list_filter(a, lambda x: NOT list_contains(s, x) AND NOT list_contains(p, x))) / greatest(len(a), 1) AS novel,
  CASE task {" ".join(f"WHEN '{t}' THEN {v}" for t, v in quality.LEAST_OVERLAP.items())} ELSE {quality.ELSE_OVERLAP} END::DOUBLE AS threshold FROM w),
f AS (SELECT *, list_filter([CASE WHEN overlap < threshold THEN 'low_lexical_overlap' END, CASE WHEN novel > {quality.MOST_NOVEL} AND task IN ('{"', '".join(quality.NOVELTY_TASKS)}') THEN 'high_novel_word_ratio' END,
  CASE WHEN ends_with(answer, '...') OR ends_with(answer, '…') THEN 'assistant_ends_with_ellipsis' END, CASE WHEN trim(coalesce(source, '')) = '' THEN 'missing_source_text' END], lambda x: x IS NOT NULL) AS flags FROM r)"""
_PHRASES = [f"CASE WHEN n = {i} THEN 'opening: {s}' END" for i, s in enumerate(quality.STARTERS)] + [f"CASE WHEN n = {i + 3} THEN 'leftover: {s}' END" for i, s in enumerate(quality.LEFTOVERS)]
_PHRASES += ["CASE WHEN n IN (5, 6) THEN 'opening: " + quality.STARTERS[2] + "' END", "CASE WHEN n = 7 THEN 'terminal_ellipsis' END", f"CASE WHEN {_Z('model', 6)} THEN 'provisional origin' END"]
_FIRST = lambda *p: "coalesce(" + ", ".join(f"CASE WHEN {_s(t, 3)} = 0 THEN '{w}' END" for t, w in p) + ")"
_SOME = lambda *p: "coalesce(" + ", ".join(f"CASE WHEN {_s(t, 2)} = 0 THEN '{w}' END" for t, w in p) + ")"
_E, _B = _Z("half", 5), f"({_Z('half', 5)} OR {_Z('both', 40)})"
_IN = lambda tag: f"NOT {_Z(tag, 25)}"
ORACLES = {
    "response_faults": f"WITH r AS (SELECT doc_id, 0 AS twice FROM labels UNION ALL SELECT doc_id, 1 FROM labels WHERE {_Z('again', 35)}) {_count(_RESPONSE, 'r')}",
    "chat_faults": _count(_CHAT, "labels"),
    "output_faults": f"WITH {runs._O} {_count(_OUTPUT, 'o')}",
    "gold_faults": f"""WITH t AS (SELECT *, {_Z('twice', 30)} AND row_number() OVER (PARTITION BY {_Z('twice', 30)} ORDER BY doc_id) = 1 AS first_twice, count(*) FILTER (WHERE {_Z('twice', 30)}) OVER () AS n_twice, count(*) OVER (PARTITION BY doc_id // 3) AS n_chunk FROM labels) {_count(_GOLD, 't')}""",
    "export_faults": f"""WITH l AS (SELECT 'r' || doc_id AS id, doc_id // 2 AS chunk, NOT {_E} AND {_IN('t')} AS t, {_B} AND {_IN('e')} AS e, NOT {_E} AND {_IN('tm')} AS tm, {_B} AND {_IN('em')} AS em, {_Z('mute', 21)} AS mute FROM labels)
        SELECT id, reason FROM (SELECT id, unnest([CASE WHEN t AND e THEN 'in both splits' END, CASE WHEN t AND NOT tm THEN 'train record without metadata' END, CASE WHEN tm AND NOT t THEN 'train metadata without a record' END, CASE WHEN e AND NOT em THEN 'eval record without metadata' END,
          CASE WHEN em AND NOT e THEN 'eval metadata without a record' END, CASE WHEN t AND mute THEN 'no answer' END, CASE WHEN e AND mute THEN 'no answer' END]) AS reason FROM l) WHERE reason IS NOT NULL
        UNION ALL SELECT NULL, 'manifest has another number of train records' UNION ALL SELECT NULL, 'manifest has another number of eval records'
        UNION ALL SELECT DISTINCT id, 'chunk in both splits' FROM l WHERE tm AND chunk IN (SELECT chunk FROM l WHERE em)""",
    "faithfulness_audit": f"WITH {_ASKED} SELECT id, task, round(overlap, 4) AS overlap_ratio, round(novel, 4) AS novel_word_ratio, len(a) AS assistant_word_count, len(s) AS source_word_count, threshold, array_to_string(flags, ',') AS flags FROM f",
    "faithfulness_worst": f"""WITH {_ASKED}, g AS (SELECT id, task, round(overlap, 4) AS overlap_ratio, len(flags) AS n_flags FROM f)
        SELECT * FROM (SELECT 'flagged' AS list, * FROM g WHERE n_flags > 0 ORDER BY n_flags DESC, overlap_ratio, id LIMIT 50) UNION ALL SELECT * FROM (SELECT 'lowest', * FROM g ORDER BY overlap_ratio, id LIMIT 25)""",
    "phrase_flags": f"SELECT flag, count(*) AS n FROM (SELECT unnest([{', '.join(_PHRASES)}]) AS flag FROM (SELECT *, {_s('phrase', 9)} AS n FROM labels)) WHERE flag IS NOT NULL GROUP BY flag",
    "canonical_values": f"SELECT {_FIRST(('side', 'side'), ('own', 'row'), ('meta', 'meta'))} AS status, 'm' AS model, NULL::VARCHAR AS run, {_SOME(('sides', 'side'), ('owns', 'row'), ('metas', 'meta'))} AS docs, count(*) AS n FROM labels GROUP BY ALL",
    "judge_focus": f"""WITH j AS (SELECT doc_id AS job_id, {runs._TASK_SQL} AS task_type, CASE WHEN {_s('dec', 4)} = 0 THEN 'reject' ELSE 'approve' END AS decision, CASE WHEN {_s('nos', 9)} > 0 THEN {_s('sc', 101)} ELSE 0 END AS score, {_Z('blk', 5)} AS b FROM labels),
        t AS (SELECT *, array_to_string(list_filter([CASE WHEN task_type = 'step_by_step' THEN 'priority_step_by_step' END, CASE WHEN decision = 'reject' THEN 'reject' END, CASE WHEN score <= 85 THEN 'borderline_score' END, CASE WHEN b THEN 'blocking_reasons_present' END], lambda x: x IS NOT NULL), ',') AS tags FROM j)
        SELECT job_id, task_type, decision, score, tags FROM t WHERE tags <> '' ORDER BY decision = 'reject' DESC, task_type = 'step_by_step' DESC, score, job_id LIMIT 12""",
}
