"""Further selections, quality reports and cross-table checks of the curation workflow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.functions.hashing import hash_mod
from curata.functions.text import normalized_key
from curata.operators.quota import hash_split, round_robin
from curata.plans.metrics import CONV_SQL, HASH_SQL, KEY_SQL, first_and_last
from curata.session import table


def _h(key: str, tag: str, modulo: int):
    return hash_mod(F.concat(F.col(key).cast("string"), F.lit(f"::{tag}")), modulo)


def _hs(key: str, tag: str, modulo: int) -> str:
    return f"({HASH_SQL.format(f'{key}::VARCHAR || chr(58) || chr(58) || {chr(39)}{tag}{chr(39)}')} % {modulo})::BIGINT"


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as jobs: split, task, score and review status by hash."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return docs.select(
        "doc_id", "source", "lang", hash_split(F.col("doc_id")).alias("split"), _h("doc_id", "task", 5).alias("task"), _h("doc_id", "score", 101).alias("score"),
        F.when(_h("doc_id", "status", 3) == 0, "teacher_generated").when(_h("doc_id", "status", 3) == 1, "human_reviewed").otherwise("rejected").alias("status"),
    )


_JOBS = f"""j AS (SELECT doc_id, source, lang, CASE WHEN {HASH_SQL.format('doc_id::VARCHAR')} % 7 = 0 THEN 'eval' ELSE 'train' END AS split,
  {_hs('doc_id', 'task', 5)} AS task, {_hs('doc_id', 'score', 101)} AS score,
  CASE {_hs('doc_id', 'status', 3)} WHEN 0 THEN 'teacher_generated' WHEN 1 THEN 'human_reviewed' ELSE 'rejected' END AS status FROM documents)"""


def strict_relaxed_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen jobs of each task from the strict pool (score 90 up); the relaxed pool (70 up) only fills what is missing."""
    j = _jobs(spark, sf_dir).where("score >= 70").withColumn("pool", F.when(F.col("score") >= 90, "strict").otherwise("relaxed"))
    w = Window.partitionBy("task").orderBy(F.desc(F.col("pool") == "strict"), F.desc("score"), "doc_id")
    return j.withColumn("n", F.row_number().over(w)).where("n <= 15").select("task", "pool", "doc_id", "score")


def review_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to review: unreviewed ones of 40 up, dealt over the sources in plain order; below that the five lowest are rejects."""
    j = _jobs(spark, sf_dir).where("status = 'teacher_generated'")
    picked = round_robin(j.where("score >= 40"), ["split"], "source", [F.desc("score"), F.asc("doc_id")], ["source"], 24).withColumn("what", F.lit("review"))
    low = j.where("score < 40").withColumn("n", F.row_number().over(Window.partitionBy("split").orderBy("score", "doc_id"))).where("n <= 5").drop("n").withColumn("what", F.lit("reject"))
    return picked.unionByName(low).select("what", "split", "source", "doc_id", "score")


def small_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job for each split and task: best score first, then source and id."""
    j = _jobs(spark, sf_dir).where("task < 4")
    return j.groupBy("split", "task").agg(F.min_by(F.struct("doc_id", "source", "score"), F.struct(-F.col("score"), "source", "doc_id")).alias("b")).select("split", "task", "b.*")


def approved_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of reviewed rows with the run as prefix."""
    return _jobs(spark, sf_dir).where("status = 'human_reviewed' and score >= 70").select(F.concat_ws("::", F.lit("run1"), "split", F.format_string("%08d", "doc_id")).alias("output_id"))


def percentile_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length at the rounded index p of the sorted lengths of each language, from counts by length (few whatever the rows)."""
    counts = table(spark, sf_dir, "documents").groupBy("lang", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("len")).agg(F.count("*").alias("n"))
    by = Window.partitionBy("lang")
    ranked = counts.withColumns({"upto": F.sum("n").over(by.orderBy("len")), "total": F.sum("n").over(by)})
    at = lambda p: F.min(F.when(F.col("upto") > F.bround(F.lit(p / 100) * (F.col("total") - 1), 0), F.col("len")))
    return ranked.groupBy("lang").agg(at(50).alias("p50"), at(90).alias("p90"), at(95).alias("p95"))


def answer_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a stock opening, a leftover mark or a cut end, by role."""
    t = F.lower(F.trim(F.coalesce("text", F.lit(""))))
    flags = F.array_compact(
        F.array(
            F.when(t.startswith("the ") | t.startswith("in "), "stock_opening"),
            F.when(t.contains("###") | t.contains("```") | t.contains("|"), "markup_leftover"),
            F.when(t.endswith("...") | t.endswith("…") | ~t.rlike(r"[.!?]$"), "cut_end"),
            F.when(F.length(t) < 40, "stub"),
        )
    )
    return table(spark, sf_dir, "conversations").select("role", F.explode(flags).alias("flag")).groupBy("role", "flag").agg(F.count("*").alias("n"))


def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a sidecar: the sidecar's value where it is filled, else the row's, else a default."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    side = labels.select("doc_id", F.when(F.col("quality") == 1, "reviewed").otherwise("").alias("status"), F.when(F.col("toxic") == 1, F.lit("flagged")).alias("source"))
    j = docs.select("doc_id", "lang", F.col("source").alias("own")).join(side, "doc_id", "left")
    value = lambda *cols: F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in cols), F.lit("missing"))
    return j.groupBy("lang", value("status").alias("status"), value("source", "own").alias("origin")).agg(F.count("*").alias("n"))


def split_overlap_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts, answers and pairs, compared whole: how many each split has and how many both have."""
    c = first_and_last(spark, sf_dir).withColumn("e", hash_split(F.col("conv_id"), 3) == "eval")
    p, a = normalized_key(F.col("prompt")), normalized_key(F.col("answer"))
    long = c.select("e", F.explode(F.create_map(F.lit("prompt"), p, F.lit("answer"), a, F.lit("pair"), F.concat(p, F.lit("\u0001"), a))).alias("kind", "key"))
    sides = long.groupBy("kind", "key").agg(F.max("e").alias("in_eval"), F.max(~F.col("e")).alias("in_train"))
    return sides.groupBy("kind").agg(F.count_if("in_train").alias("n_train"), F.count_if("in_eval").alias("n_eval"), F.count_if(F.col("in_train") & F.col("in_eval")).alias("n_both"))


def usage_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage by task: rows that report any, and their sums; null where none does."""
    j = _jobs(spark, sf_dir).withColumn("tokens", F.when((_h("doc_id", "usage", 3) > 0) & (F.col("task") != 4), _h("doc_id", "tokens", 500)))
    return j.groupBy("task").agg(F.count("*").alias("n_rows"), F.count("tokens").alias("n_reporting"), F.sum("tokens").alias("tokens"), F.round(F.try_divide(F.count("tokens"), F.count("*")), 4).alias("coverage"))


def focus_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve cases to look at: rejected first, then those with a tag, by score."""
    j = _jobs(spark, sf_dir)
    tags = F.array_join(F.array_compact(F.array(F.when(F.col("score") < 60, "low_score"), F.when(F.col("task") == 0, "priority_task"), F.when(F.col("split") == "eval", "evaluation"))), ",")
    return j.withColumn("tags", tags).orderBy(F.desc(F.col("status") == "rejected"), F.desc(F.col("tags") != ""), "score", "doc_id").limit(12).select("doc_id", "status", "tags", "score")


def response_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses against their jobs: fields that differ, and responses without a job."""
    jobs = _jobs(spark, sf_dir)
    r = jobs.where(_h("doc_id", "answered", 4) > 0).select(
        F.when(_h("doc_id", "stray", 50) == 0, F.col("doc_id") + 1_000_000_000_000).otherwise(F.col("doc_id")).alias("doc_id"),
        F.when(_h("doc_id", "wrong", 40) == 0, F.lit("other")).otherwise(F.col("split")).alias("r_split"), F.when(_h("doc_id", "task2", 30) == 0, 9).otherwise(F.col("task")).alias("r_task"),
    )
    j = r.join(jobs.select("doc_id", "split", "task"), "doc_id", "left")
    reasons = F.array_compact(F.array(F.when(F.col("split").isNull(), "no job"), F.when(F.col("split") != F.col("r_split"), "split differs"), F.when(F.col("task") != F.col("r_task"), "task differs")))
    return j.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def export_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and sidecar of an export: ids on one side only."""
    ids = table(spark, sf_dir, "documents").select("doc_id")
    records, side = ids.where(_h("doc_id", "rec", 50) > 0), ids.where(_h("doc_id", "side", 60) > 0)
    left = records.exceptAll(side).withColumn("side", F.lit("record only"))
    return left.unionByName(side.exceptAll(records).withColumn("side", F.lit("sidecar only")))


def smoke_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first evaluation row of each task, with how many there are."""
    return _jobs(spark, sf_dir).where("split = 'eval'").groupBy("task").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))


def turn_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most turns and characters that a conversation has."""
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    return per.agg(F.max("turns").alias("max_turns"), F.max("chars").alias("max_chars"), F.count("*").alias("n"))


#: A recipe: name, pattern and smallest size of the first document that serves it.
RECIPES = [("numbers", "[0-9]{3}", 100), ("address", "@", 50), ("licence", "License", 50), ("long", ".", 5000), ("none", "no such text at all", 0)]


def recipe_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each recipe the first document in order that fits it, in one pass over the documents."""
    docs = table(spark, sf_dir, "documents")
    fits = F.array_compact(F.array(*(F.when(F.coalesce("text", F.lit("")).rlike(p) & (F.col("n_chars") >= n), name) for name, p, n in RECIPES)))
    return docs.select("doc_id", F.explode(fits).alias("recipe")).groupBy("recipe").agg(F.min("doc_id").alias("doc_id"))


QUERIES = {
    f.__name__: f
    for f in (
        strict_relaxed_pools, review_selection, small_subset, approved_ids, percentile_index, answer_flags, canonical_rows, split_overlap_metrics, usage_sums,
        focus_cases, response_violations, export_agreement, smoke_pick, turn_maxima, recipe_jobs,
    )
}

_T = "lower(trim(coalesce(text, '')))"
_AT = lambda p: f"min(len) FILTER (WHERE upto > round_even({p / 100} * (total - 1), 0))"
ORACLES = {
    "strict_relaxed_pools": f"""WITH {_JOBS}, p AS (SELECT *, CASE WHEN score >= 90 THEN 'strict' ELSE 'relaxed' END AS pool FROM j WHERE score >= 70)
        SELECT task, pool, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY pool = 'strict' DESC, score DESC, doc_id) AS n FROM p) WHERE n <= 15""",
    "review_selection": f"""WITH {_JOBS}, u AS (SELECT * FROM j WHERE status = 'teacher_generated'),
        r AS (SELECT *, row_number() OVER (PARTITION BY split, source ORDER BY score DESC, doc_id) AS k FROM u WHERE score >= 40),
        q AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY k, source) AS n FROM r),
        l AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY score, doc_id) AS n FROM u WHERE score < 40)
        SELECT 'review' AS what, split, source, doc_id, score FROM q WHERE n <= 24 UNION ALL SELECT 'reject', split, source, doc_id, score FROM l WHERE n <= 5""",
    "small_subset": f"WITH {_JOBS} SELECT split, task, doc_id, source, score FROM (SELECT *, row_number() OVER (PARTITION BY split, task ORDER BY score DESC, source, doc_id) AS n FROM j WHERE task < 4) WHERE n = 1",
    "approved_ids": f"WITH {_JOBS} SELECT 'run1::' || split || '::' || format('{{:08d}}', doc_id) AS output_id FROM j WHERE status = 'human_reviewed' AND score >= 70",
    "percentile_index": f"""WITH c AS (SELECT lang, length(coalesce(text, '')) AS len, count(*) AS n FROM documents GROUP BY ALL),
        r AS (SELECT *, sum(n) OVER (PARTITION BY lang ORDER BY len) AS upto, sum(n) OVER (PARTITION BY lang) AS total FROM c)
        SELECT lang, {_AT(50)} AS p50, {_AT(90)} AS p90, {_AT(95)} AS p95 FROM r GROUP BY lang""",
    "answer_flags": f"""SELECT role, flag, count(*) AS n FROM (SELECT role, unnest([
        CASE WHEN starts_with({_T}, 'the ') OR starts_with({_T}, 'in ') THEN 'stock_opening' END,
        CASE WHEN contains({_T}, '###') OR contains({_T}, '```') OR contains({_T}, '|') THEN 'markup_leftover' END,
        CASE WHEN ends_with({_T}, '...') OR ends_with({_T}, '…') OR NOT regexp_matches({_T}, '[.!?]$') THEN 'cut_end' END,
        CASE WHEN length({_T}) < 40 THEN 'stub' END]) AS flag FROM conversations) WHERE flag IS NOT NULL GROUP BY ALL""",
    "canonical_rows": """SELECT lang, CASE WHEN quality = 1 THEN 'reviewed' ELSE 'missing' END AS status, CASE WHEN toxic = 1 THEN 'flagged' ELSE source END AS origin, count(*) AS n
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
    "split_overlap_metrics": f"""WITH {CONV_SQL}, k AS (SELECT {HASH_SQL.format('conv_id::VARCHAR')} % 3 = 0 AS e, {KEY_SQL.format('prompt')} AS p, {KEY_SQL.format('answer')} AS a FROM c),
        l AS (SELECT e, 'prompt' AS kind, p AS key FROM k UNION ALL SELECT e, 'answer', a FROM k UNION ALL SELECT e, 'pair', p || chr(1) || a FROM k),
        s AS (SELECT kind, key, max(e) AS in_eval, max(NOT e) AS in_train FROM l GROUP BY ALL)
        SELECT kind, count(*) FILTER (WHERE in_train) AS n_train, count(*) FILTER (WHERE in_eval) AS n_eval, count(*) FILTER (WHERE in_train AND in_eval) AS n_both FROM s GROUP BY kind""",
    "usage_sums": f"""WITH {_JOBS}, u AS (SELECT task, CASE WHEN {_hs('doc_id', 'usage', 3)} > 0 AND task <> 4 THEN {_hs('doc_id', 'tokens', 500)} END AS t FROM j)
        SELECT task, count(*) AS n_rows, count(t) AS n_reporting, sum(t)::BIGINT AS tokens, round(count(t) / count(*), 4) AS coverage FROM u GROUP BY task""",
    "focus_cases": f"""WITH {_JOBS}, t AS (SELECT *, array_to_string(list_filter([CASE WHEN score < 60 THEN 'low_score' END, CASE WHEN task = 0 THEN 'priority_task' END, CASE WHEN split = 'eval' THEN 'evaluation' END], lambda x: x IS NOT NULL), ',') AS tags FROM j)
        SELECT doc_id, status, tags, score FROM t ORDER BY status = 'rejected' DESC, tags <> '' DESC, score, doc_id LIMIT 12""",
    "response_violations": f"""WITH {_JOBS},
        r AS (SELECT CASE WHEN {_hs('doc_id', 'stray', 50)} = 0 THEN doc_id + 1000000000000 ELSE doc_id END AS doc_id, CASE WHEN {_hs('doc_id', 'wrong', 40)} = 0 THEN 'other' ELSE split END AS s,
              CASE WHEN {_hs('doc_id', 'task2', 30)} = 0 THEN 9 ELSE task END AS t FROM j WHERE {_hs('doc_id', 'answered', 4)} > 0),
        f AS (SELECT unnest([CASE WHEN j.split IS NULL THEN 'no job' END, CASE WHEN j.split <> s THEN 'split differs' END, CASE WHEN j.task <> t THEN 'task differs' END]) AS reason FROM r LEFT JOIN j USING (doc_id))
        SELECT reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY reason""",
    "export_agreement": f"""WITH d AS (SELECT doc_id, {_hs('doc_id', 'rec', 50)} > 0 AS r, {_hs('doc_id', 'side', 60)} > 0 AS s FROM documents)
        SELECT doc_id, CASE WHEN r THEN 'record only' ELSE 'sidecar only' END AS side FROM d WHERE r <> s""",
    "smoke_pick": f"WITH {_JOBS} SELECT task, min(doc_id) AS first_id, count(*) AS n FROM j WHERE split = 'eval' GROUP BY task",
    "turn_maxima": "SELECT max(t) AS max_turns, max(c)::BIGINT AS max_chars, count(*) AS n FROM (SELECT count(*) AS t, sum(length(coalesce(text, ''))) AS c FROM conversations GROUP BY conv_id)",
    "recipe_jobs": "SELECT recipe, min(doc_id) AS doc_id FROM (SELECT doc_id, unnest(["
    + ", ".join(f"CASE WHEN regexp_matches(coalesce(text, ''), '{p}') AND n_chars >= {n} THEN '{name}' END" for name, p, n in RECIPES)
    + "]) AS recipe FROM documents) WHERE recipe IS NOT NULL GROUP BY recipe",
}
