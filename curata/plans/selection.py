"""Deterministic splits and quota selection over ``documents``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.functions.hashing import hash_mod, stable_hash
from curata.functions.text import normalized_key
from curata.operators.numbering import number_rows
from curata.operators.quota import balanced_pick, chunk_exclusions, picks, round_robin, top_off, wave
from curata.operators.numbering import number_rows
from curata.operators.quota import hash_split as split_of
from curata.plans.metrics import HASH_SQL, KEY_SQL
from curata.session import frozen, table


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per language, source and split; one in seven goes to eval."""
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang", "source", split_of(F.col("doc_id")).alias("split")).agg(F.count("*").alias("n"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(split_of(F.col("doc_id")).alias("split"), "source", "doc_id", F.col("n_chars").alias("score"), stable_hash(F.col("doc_id")).alias("tie"), hash_mod(F.col("source"), 1000).alias("turn"))


def round_robin_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quota of 40 for each split, dealt in rounds over the sources."""
    dealt = round_robin(candidates(spark, sf_dir), bucket=["split"], group="source", order=[F.desc("score"), F.asc("tie")], turn=["turn", "source"], quota=40)
    return dealt.select("split", "source", "doc_id", "score")


def balanced_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty rows of each split, evaluation first, balanced over sources across both."""
    c = candidates(spark, sf_dir).select("split", "source", "doc_id", "score")
    order: list[Column] = [F.desc("score"), F.asc("doc_id")]
    first = balanced_pick(c.where("split = 'eval'"), "source", order, 30)
    second = balanced_pick(c.where("split = 'train'"), "source", order, 30, picks(first, group="source"))
    return first.unionByName(second)


#: Tasks in the order in which waves serve them.
TASKS = ["clarification", "step_by_step", "uncertainty_escalation", "troubleshooting", "faq_direct_answer"]


def _tasked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as candidates of a task each, computed once."""
    docs = table(spark, sf_dir, "documents")
    number = hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit("::task")), 5)
    task = F.get(F.array(*map(F.lit, TASKS)), number.cast("int"))
    return frozen(docs.select(split_of(F.col("doc_id")).alias("split"), task.alias("task"), "source", "doc_id", F.col("n_chars").alias("score"), F.sha2(normalized_key(F.col("text")), 256).alias("chunk")))


def _buckets(evaluation: int, train: int) -> dict[tuple[str, str], int]:
    return {(s, t): n for s, n in (("eval", evaluation), ("train", train)) for t in TASKS}


def topoff_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight seeds (the longest documents by hash), filled up to seven rows of each task (two of them for evaluation) without a repeated text."""
    rows = _tasked(spark, sf_dir)
    seeds = rows.where(hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit("::seed")), 97) == 0).orderBy(F.desc("score"), "doc_id").limit(8)
    return top_off(rows, seeds, _buckets(2, 5), "split", "task", "source", "chunk", "score", "doc_id").drop("chunk")


def curated_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole quota of ten rows for each task (two of them for evaluation), from no seeds."""
    rows = _tasked(spark, sf_dir)
    return top_off(rows, rows.limit(0), _buckets(2, 8), "split", "task", "source", "chunk", "score", "doc_id").drop("chunk")


def quota_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the curated selection holds by split, task and source, with subtotals; level 7 is all of it."""
    return curated_quota(spark, sf_dir).cube("split", "task", "source").agg(F.count("*").alias("n"), F.sum("score").alias("score"), F.grouping_id().cast("long").alias("level"))


def wave_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks of their source, with a candidate for two tasks in five: computed once."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk"), F.col("source").alias("doc"), split_of(F.col("doc_id")).alias("split"), hash_mod(F.col("source"), 1000).alias("turn"), F.explode(F.array(*map(F.lit, TASKS))).alias("task"))
    key = F.concat(F.col("chunk").cast("string"), F.lit("::"), F.col("task"))
    made = docs.withColumns({"score": hash_mod(F.concat(key, F.lit("::score")), 101), "tie": stable_hash(key)})
    return frozen(made.where(hash_mod(F.concat(key, F.lit("::draft")), 5) < 2))


WAVE = {("eval", t): n for t, n in zip(TASKS, (3, 4, 5, 4, 60), strict=True)} | {("train", t): n for t, n in zip(TASKS, (9, 12, 7, 20, 15), strict=True)}


def _excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that labelled toxic rows use."""
    used = table(spark, sf_dir, "labels").where("toxic = 1").select(F.array("doc_id").alias("source_chunk_ids"))
    return chunk_exclusions(used)


def multi_task_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wave of five tasks with quotas for each split; a selected chunk is spent for the tasks behind, and excluded ones for all."""
    return wave(wave_candidates(spark, sf_dir), WAVE, TASKS, _excluded(spark, sf_dir))[0].withColumn("place", F.col("place").cast("long"))


def wave_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each split and task of the wave: candidates, quota, selected rows and what is lacking."""
    c, gone = wave_candidates(spark, sf_dir), _excluded(spark, sf_dir)
    chosen, lacks = wave(c, WAVE, TASKS, gone)
    have = c.join(gone, "chunk", "left_anti").groupBy("split", "task").agg(F.count("*").alias("n_available"))
    goal = spark.createDataFrame([(s, t, n, lacks[s, t]) for (s, t), n in WAVE.items()], "split string, task string, quota long, lacking long")
    picked = chosen.groupBy("split", "task").agg(F.count("*").alias("n_selected"))
    joined = goal.join(have, ["split", "task"], "left").join(picked, ["split", "task"], "left")
    return joined.select("split", "task", F.coalesce("n_available", F.lit(0)).alias("n_available"), "quota", F.coalesce("n_selected", F.lit(0)).alias("n_selected"), "lacking")


REVIEW = {("train", t): n for t, n in zip(TASKS, (4, 9, 5, 12, 6), strict=True)} | {("eval", t): n for t, n in zip(TASKS, (3, 2, 4, 5, 30), strict=True)}


def review_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to review: scores from 40 up, dealt over the sources in plain order, training first; pairs of neighbouring documents share a chunk, in both splits."""
    c = wave_candidates(spark, sf_dir).where("score >= 40").withColumns({"turn": F.lit(0), "id": F.col("chunk"), "chunk": F.floor(F.col("chunk") / 2)})
    # of a task's rows of one chunk the better one stands for it
    best = F.row_number().over(Window.partitionBy("split", "task", "chunk").orderBy(F.desc("score"), "tie"))
    return wave(frozen(c.withColumn("_n", best).where("_n = 1").drop("_n")), REVIEW, TASKS, None, ["train", "eval"])[0].withColumn("place", F.col("place").cast("long"))


def slot_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each of eight slots, each from the source that has the fewest so far."""
    rows = _tasked(spark, sf_dir)
    return top_off(rows, rows.limit(0), dict.fromkeys(SLOTS, 1), "split", "task", "source", "chunk", "score", "doc_id", group_first=True).drop("chunk")


SLOTS = [("train", t) for t in ("faq_direct_answer", "troubleshooting", "step_by_step", "clarification", "uncertainty_escalation")] + [("eval", t) for t in ("faq_direct_answer", "clarification", "step_by_step")]


def approved_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of approved rows with their run, numbered in the order of split, task, source and id."""
    rows = _tasked(spark, sf_dir).where(hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit("::ok")), 3) == 0)
    keyed = rows.select(F.struct("split", "task", "source", "doc_id").alias("key"), F.concat(F.lit("run1::job_"), F.col("doc_id").cast("string")).alias("output_id"))
    return number_rows(keyed, "key").select("number", "output_id")


def focus_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task alone over chosen sources: its split is one in eight, 24 rows to train on and 6 to evaluate, numbered through, evaluation first."""
    docs = table(spark, sf_dir, "documents").where(hash_mod(F.col("source"), 3) > 0)
    rows = docs.select(split_of(F.col("doc_id"), 8).alias("split"), F.lit("step").alias("task"), F.col("source").alias("doc"), F.col("doc_id").alias("chunk"), F.col("n_chars").alias("score"), stable_hash(F.col("doc_id")).alias("tie"), hash_mod(F.col("source"), 1000).alias("turn"))
    chosen, _ = wave(frozen(rows), {("eval", "step"): 6, ("train", "step"): 24}, ["step"])
    number = F.row_number().over(Window.orderBy("split", "place"))  # thirty rows
    return chosen.select(F.format_string("step::%s::%04d", "split", number).alias("job_id"), "split", F.col("doc").alias("source"), F.col("chunk").alias("doc_id"))


def labelled_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved, rejected and unreviewed documents of each language."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels")
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").withColumn("part", F.lit("approved"))
    bad = docs.join(labels.where("quality = 0"), "doc_id", "left_semi").withColumn("part", F.lit("rejected"))
    rest = docs.join(labels, "doc_id", "left_anti").withColumn("part", F.lit("unreviewed"))
    return good.unionByName(bad).unionByName(rest).groupBy("lang", "part").agg(F.count("*").alias("n"))


def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of each split and those in both, by language; one row a text crosses the network."""
    docs = table(spark, sf_dir, "documents")
    is_eval = split_of(F.col("doc_id")) == "eval"
    keys = docs.groupBy("lang", F.sha2(normalized_key(F.col("text")), 256).alias("key")).agg(F.max(is_eval).alias("e"), F.max(~is_eval).alias("t"))
    return keys.groupBy("lang").agg(F.count_if("e").alias("n_eval"), F.count_if("t").alias("n_train"), F.count_if(F.col("e") & F.col("t")).alias("n_shared"))


def curation_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: labelled documents through the gates, split, dealt by quota, without a text in both splits."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi").where(F.length(F.trim("text")) >= 80)
    rows = rows.select("doc_id", "lang", "source", "n_chars", split_of(F.col("doc_id")).alias("split"), F.sha2(normalized_key(F.col("text")), 256).alias("key"), stable_hash(F.col("doc_id")).alias("tie"), hash_mod(F.col("source"), 1000).alias("turn"))
    # a text in both splits stays in evaluation only, and once in either; its columns travel with the key
    once = rows.groupBy("key").agg(F.min(F.struct("split", "doc_id", "lang", "source", "n_chars", "tie", "turn")).alias("first")).select("first.*")
    dealt = round_robin(once, bucket=["split", "lang"], group="source", order=[F.desc("n_chars"), F.asc("tie")], turn=["turn", "source"], quota=20)
    return dealt.select("split", "lang", "source", "doc_id", "n_chars")


QUERIES = {f.__name__: f for f in (hash_split, round_robin_quota, balanced_quota, topoff_quota, curated_quota, quota_report, multi_task_wave, wave_report, focus_wave, review_wave, slot_subset, approved_batch, labelled_partition, split_leakage, curation_export)}

_H = HASH_SQL.format("doc_id::VARCHAR")
_SPLIT = f"CASE WHEN {_H} % 7 = 0 THEN 'eval' ELSE 'train' END"
_KEY = f"sha256({KEY_SQL.format('text')})"


_TASK = "['" + "', '".join(TASKS) + "']"
_ROWS = f"""r AS (SELECT {_SPLIT} AS split, {_TASK}[({HASH_SQL.format("doc_id::VARCHAR || '::task'")} % 5)::INT + 1] AS task, source, doc_id, n_chars AS score, {_KEY} AS chunk FROM documents)"""


def _top_off_sql(per: tuple[int, int] | dict, first: str, order: str = "score DESC, r.source") -> str:
    """CTEs s0 (the seeds) to s10, a bucket each."""
    out = [f"s0 AS ({first})"]
    for i, ((split, task), n) in enumerate((per if isinstance(per, dict) else _buckets(*per)).items()):
        out.append(f"""s{i + 1} AS (SELECT * FROM s{i} UNION ALL SELECT split, task, source, doc_id, score, chunk FROM (
          SELECT r.*, row_number() OVER (ORDER BY coalesce(p.n, 0), {order}, doc_id) AS place
          FROM r LEFT JOIN (SELECT source, count(*) AS n FROM s{i} GROUP BY source) p ON r.source = p.source
          WHERE split = '{split}' AND task = '{task}' AND doc_id NOT IN (SELECT doc_id FROM s{i}) AND chunk NOT IN (SELECT chunk FROM s{i}))
          WHERE place <= {n} - (SELECT count(*) FROM s{i} WHERE split = '{split}' AND task = '{task}'))""")
    return ", ".join(out)


_SEED = HASH_SQL.format("doc_id::VARCHAR || '::seed'")
_CURATED = f"WITH {_ROWS}, {_top_off_sql((2, 8), 'SELECT * FROM r WHERE false')}"


def _wave_sql() -> str:
    quota = lambda t: f"CASE split WHEN 'eval' THEN {WAVE['eval', t]} ELSE {WAVE['train', t]} END"
    key = "doc_id::VARCHAR || '::' || task"
    out = [f"""c AS (SELECT * FROM (SELECT doc_id AS chunk, source AS doc, {_SPLIT} AS split, ({HASH_SQL.format('source')} % 1000)::BIGINT AS turn, task,
          ({HASH_SQL.format(key + " || '::score'")} % 101)::BIGINT AS score, {HASH_SQL.format(key)} AS tie, {HASH_SQL.format(key + " || '::draft'")} % 5 < 2 AS drafted
          FROM (SELECT *, unnest({_TASK}) AS task FROM documents)) WHERE drafted AND chunk NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))""", "w0 AS (SELECT split, task, doc, chunk, score, 0 AS place FROM c WHERE false)"]
    for i, t in enumerate(TASKS):
        out.append(f"""w{i + 1} AS (SELECT * FROM w{i} UNION ALL SELECT split, task, doc, chunk, score, place FROM (
          SELECT *, row_number() OVER (PARTITION BY split ORDER BY round, turn, doc) AS place FROM (
            SELECT *, row_number() OVER (PARTITION BY split, doc ORDER BY score DESC, tie) AS round FROM c WHERE task = '{t}' AND chunk NOT IN (SELECT chunk FROM w{i})))
          WHERE place <= {quota(t)})""")
    return "WITH " + ", ".join(out)


def _review_sql() -> str:
    key = "doc_id::VARCHAR || '::' || task"
    out = [f"""c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split, task, chunk ORDER BY score DESC, tie) AS n FROM (SELECT doc_id // 2 AS chunk, source AS doc, {_SPLIT} AS split, task,
          ({HASH_SQL.format(key + " || '::score'")} % 101)::BIGINT AS score, {HASH_SQL.format(key)} AS tie, {HASH_SQL.format(key + " || '::draft'")} % 5 < 2 AS drafted
          FROM (SELECT *, unnest({_TASK}) AS task FROM documents)) WHERE drafted AND score >= 40) WHERE n = 1)""", "w0 AS (SELECT split, task, doc, chunk, score, 0 AS place FROM c WHERE false)"]
    for i, ((split, t), n) in enumerate(REVIEW.items()):
        out.append(f"""w{i + 1} AS (SELECT * FROM w{i} UNION ALL SELECT split, task, doc, chunk, score, place FROM (SELECT *, row_number() OVER (ORDER BY round, doc) AS place FROM (
            SELECT *, row_number() OVER (PARTITION BY doc ORDER BY score DESC, tie) AS round FROM c WHERE split = '{split}' AND task = '{t}' AND chunk NOT IN (SELECT chunk FROM w{i}))) WHERE place <= {n})""")
    return "WITH " + ", ".join(out) + " SELECT * FROM w10"


ORACLES = {
    "hash_split": f"SELECT lang, source, {_SPLIT} AS split, count(*) AS n FROM documents GROUP BY ALL",
    "round_robin_quota": f"""
        WITH h AS (SELECT doc_id, source, n_chars AS score, {_H} AS tie, ({HASH_SQL.format('source')} % 1000)::BIGINT AS turn FROM documents),
        c AS (SELECT *, CASE WHEN tie % 7 = 0 THEN 'eval' ELSE 'train' END AS split FROM h),
        r AS (SELECT *, row_number() OVER (PARTITION BY split, source ORDER BY score DESC, tie) AS round FROM c),
        q AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY round, turn, source) AS place FROM r)
        SELECT split, source, doc_id, score FROM q WHERE place <= 40""",
    "balanced_quota": f"""
        WITH c AS (SELECT {_SPLIT} AS split, source, doc_id, n_chars AS score FROM documents),
        k AS (SELECT *, row_number() OVER (PARTITION BY split, source ORDER BY score DESC, doc_id) - 1 AS k FROM c),
        a AS (SELECT split, source, doc_id, score FROM k WHERE split = 'eval' ORDER BY k, k, score DESC, doc_id LIMIT 30),
        g AS (SELECT source, count(*) AS g FROM a GROUP BY source),
        b AS (SELECT split, k.source, doc_id, score FROM k LEFT JOIN g ON k.source = g.source WHERE split = 'train' ORDER BY coalesce(g, 0) + k, k, score DESC, doc_id LIMIT 30)
        SELECT * FROM a UNION ALL SELECT * FROM b""",
    "topoff_quota": f"""WITH {_ROWS}, {_top_off_sql((2, 5), f"SELECT * FROM r WHERE {_SEED} % 97 = 0 ORDER BY score DESC, doc_id LIMIT 8")}
        SELECT split, task, source, doc_id, score FROM s10""",
    "curated_quota": f"{_CURATED} SELECT split, task, source, doc_id, score FROM s10",
    "quota_report": f"{_CURATED} SELECT split, task, source, count(*) AS n, sum(score)::BIGINT AS score, grouping_id(split, task, source)::BIGINT AS level FROM s10 GROUP BY CUBE (split, task, source)",
    "multi_task_wave": f"{_wave_sql()} SELECT * FROM w5",
    "wave_report": f"""{_wave_sql()}, g AS (SELECT * FROM (VALUES {", ".join(f"('{s}', '{t}', {n})" for (s, t), n in WAVE.items())}) v(split, task, quota)),
        a AS (SELECT split, task, count(*) AS n FROM c GROUP BY ALL), p AS (SELECT split, task, count(*) AS n FROM w5 GROUP BY ALL)
        SELECT split, task, coalesce(a.n, 0) AS n_available, quota, coalesce(p.n, 0) AS n_selected, quota - coalesce(p.n, 0) AS lacking FROM g LEFT JOIN a USING (split, task) LEFT JOIN p USING (split, task)""",
    "review_wave": _review_sql(),
    "slot_subset": f"WITH {_ROWS}, {_top_off_sql(dict.fromkeys(SLOTS, 1), 'SELECT * FROM r WHERE false', 'r.source, score DESC')} SELECT split, task, source, doc_id, score FROM s8",
    "approved_batch": f"""WITH {_ROWS} SELECT row_number() OVER (ORDER BY split, task, source, doc_id) - 1 AS number, 'run1::job_' || doc_id AS output_id FROM r WHERE {HASH_SQL.format("doc_id::VARCHAR || '::ok'")} % 3 = 0""",
    "focus_wave": f"""WITH c AS (SELECT CASE WHEN {_H} % 8 = 0 THEN 'eval' ELSE 'train' END AS split, source, doc_id, n_chars, {_H} AS tie, ({HASH_SQL.format('source')} % 1000)::BIGINT AS turn FROM documents WHERE {HASH_SQL.format('source')} % 3 > 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY split, source ORDER BY n_chars DESC, tie) AS round FROM c),
        q AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY round, turn, source) AS place FROM r)
        SELECT format('step::{{}}::{{:04d}}', split, row_number() OVER (ORDER BY split, place)) AS job_id, split, source, doc_id FROM q WHERE place <= CASE split WHEN 'eval' THEN 6 ELSE 24 END""",
    "labelled_partition": """SELECT lang, CASE WHEN quality = 1 THEN 'approved' WHEN quality = 0 THEN 'rejected' ELSE 'unreviewed' END AS part, count(*) AS n
        FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id) GROUP BY ALL""",
    "split_leakage": f"""
        WITH k AS (SELECT lang, {_KEY} AS key, max({_SPLIT} = 'eval') AS e, max({_SPLIT} = 'train') AS t FROM documents GROUP BY ALL)
        SELECT lang, count(*) FILTER (WHERE e) AS n_eval, count(*) FILTER (WHERE t) AS n_train, count(*) FILTER (WHERE e AND t) AS n_shared FROM k GROUP BY lang""",
    "curation_export": f"""
        WITH r AS (SELECT doc_id, lang, source, n_chars, {_SPLIT} AS split, {_KEY} AS key, {_H} AS tie, ({HASH_SQL.format('source')} % 1000)::BIGINT AS turn
                   FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND length(trim(text)) >= 80),
        o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY split, doc_id) AS n FROM r) WHERE n = 1),
        d AS (SELECT *, row_number() OVER (PARTITION BY split, lang, source ORDER BY n_chars DESC, tie) AS round FROM o),
        q AS (SELECT *, row_number() OVER (PARTITION BY split, lang ORDER BY round, turn, source) AS place FROM d)
        SELECT split, lang, source, doc_id, n_chars FROM q WHERE place <= 20""",
}
