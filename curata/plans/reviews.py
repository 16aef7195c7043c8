"""Review, promotion and run comparisons over ``labels`` and ``conversations``, with hashed scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions.hashing import hash_mod
from curata.operators import review
from curata.operators.numbering import batches
from curata.plans.metrics import CONV_SQL, HASH_SQL, first_and_last
from curata.session import table

TASKS = ["clarification", "step_by_step", "uncertainty_escalation", "troubleshooting", "faq_direct_answer"]


def _h(key: str, tag: str, modulo: int) -> Column:
    return hash_mod(F.concat(F.col(key).cast("string"), F.lit(f"::{tag}")), modulo)


def _hs(key: str, tag: str, modulo: int) -> str:
    return f"({HASH_SQL.format(f'{key}::VARCHAR || chr(58) || chr(58) || {chr(39)}{tag}{chr(39)}')} % {modulo})::BIGINT"


def review_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels against a perturbed review of them: states of the overlay."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    kind = _h("doc_id", "overlay", 10)
    kept = labels.where(kind != 0).withColumn("quality", F.when(kind == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    extra = labels.where(kind == 2).withColumn("doc_id", F.col("doc_id") + 1_000_000_000_000)
    return review.overlay(labels, kept.unionByName(extra), "doc_id", ["quality", "toxic"]).groupBy("state").agg(F.count("*").alias("n"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = first_and_last(spark, sf_dir)
    return c.withColumns({"score": review.normalize_score(_h("conv_id", "judge", 101)), "decision": F.when(_h("conv_id", "decision", 4) > 0, "approve").otherwise("reject")})


def auto_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged answers after the gates: by final decision and status."""
    r = review.auto_review(_judged(spark, sf_dir), "answer", "decision", "score")
    return r.select("conv_id", "final_decision", "review_status", F.array_join("blocking_reasons", "; ").alias("reasons"))


def artifact_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the artifacts of their texts."""
    docs = table(spark, sf_dir, "documents")
    reasons = review.blocking_reasons(F.col("text"))
    return docs.select("lang", F.explode_outer(reasons).alias("reason")).groupBy("lang", F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("n"))


def promote_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promoted answers whose chunk (ten conversations share one) is in both splits, which an export must refuse."""
    r = review.auto_review(_judged(spark, sf_dir), "answer", "decision", "score")
    p = review.promote(r, ["codex_reviewed"], "answer").withColumns({"split": F.when(_h("conv_id", "split", 7) == 0, "eval").otherwise("train"), "chunk": F.floor(F.col("conv_id") / 10)})
    return review.split_overlap(p, "split", "chunk")


def _run(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    score = _h("doc_id", f"run{run}", 101)
    return labels.select("doc_id", _h("doc_id", "task", 5).alias("task"), score.alias("score"), F.when(score >= 40, "approve").otherwise("reject").alias("decision"))


def judge_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two judge runs by task: changed decisions, better and worse scores, mean difference."""
    a, b = _run(spark, sf_dir, "1"), _run(spark, sf_dir, "2")
    j = a.join(b.select("doc_id", F.col("score").alias("score2"), F.col("decision").alias("decision2")), "doc_id")
    delta = F.col("score2") - F.col("score")
    return j.groupBy("task").agg(
        F.count("*").alias("n"), F.count_if(F.col("decision") != F.col("decision2")).alias("n_changed"), F.count_if(delta > 0).alias("n_improved"),
        F.count_if(delta < 0).alias("n_worsened"), F.count_if(delta == 0).alias("n_same"), F.round(F.avg(delta), 2).alias("mean_delta"),
    )


def pair_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged cases of two runs (other decision, large difference, focus task), by tag and pair of decisions."""
    a, b = _run(spark, sf_dir, "1"), _run(spark, sf_dir, "2")
    j = a.join(b.select("doc_id", F.col("score").alias("score2"), F.col("decision").alias("decision2")), "doc_id")
    tags = F.array_compact(F.array(F.when(F.col("task") == 1, "focus_task"), F.when(F.col("decision") != F.col("decision2"), "decision_disagreement"), F.when(F.abs(F.col("score2") - F.col("score")) >= 20, "high_score_delta")))
    return j.select(F.explode(tags).alias("tag"), F.concat("decision", F.lit("->"), "decision2").alias("pair")).groupBy("tag", "pair").agg(F.count("*").alias("n"))


def four_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs side by side: score spread and a class by how their decisions agree, the widest first in each class."""
    from pyspark.sql import Window

    runs = [_run(spark, sf_dir, str(i)).select("doc_id", "task", F.col("score").alias(f"s{i}"), F.col("decision").alias(f"d{i}")) for i in range(1, 5)]
    j = reduce(lambda x, y: x.join(y.drop("task"), "doc_id"), runs)
    votes = reduce(lambda x, y: x + y, [F.when(F.col(f"d{i}") == "approve", 1).otherwise(0) for i in range(1, 5)])
    scores = [F.col(f"s{i}") for i in range(1, 5)]
    kind = F.when(votes == 4, "stable_approve").when(votes == 0, "stable_reject").when(votes == 2, "split").when(votes == 3, "one_rejects").otherwise("one_approves")
    k = j.select("doc_id", "task", kind.alias("class"), (F.greatest(*scores) - F.least(*scores)).alias("spread"))
    top = Window.partitionBy("class", "task").orderBy(F.desc("spread"), "doc_id")
    return k.withColumn("rank", F.row_number().over(top).cast("long")).where("rank <= 3")


def presence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that lack some cases, joined in full: how many cases by the set of runs that have them."""
    parts = [_run(spark, sf_dir, str(i)).where(_h("doc_id", f"gone{i}", 5) > 0).select("doc_id", F.lit(i).alias("run")) for i in range(1, 5)]
    long = reduce(DataFrame.unionByName, parts)
    wide = long.groupBy("doc_id").pivot("run", [1, 2, 3, 4]).count()
    present = F.concat_ws(",", *(F.when(F.col(str(i)) > 0, f"v{i}") for i in range(1, 5)))
    return wide.groupBy(present.alias("runs")).agg(F.count("*").alias("n"))


def benchmark_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference and candidate run: rows, approved, rate and average score of each, with differences; null rate if no rows."""
    def summary(run: str, tag: str) -> DataFrame:
        r = _run(spark, sf_dir, run).groupBy("task").agg(F.count("*").alias("n"), F.count_if(F.col("decision") == "approve").alias("a"), F.round(F.avg("score"), 2).alias("s"))
        return r.select("task", F.col("a").alias(f"approved_{tag}"), F.round(F.try_divide("a", "n"), 4).alias(f"rate_{tag}"), F.col("s").alias(f"score_{tag}"))

    j = summary("1", "ref").join(summary("2", "cand"), "task", "full_outer")
    return j.withColumns({"approved_delta": F.col("approved_cand") - F.col("approved_ref"), "score_delta": F.round(F.col("score_cand") - F.col("score_ref"), 4)})


def microbatch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of eight rows within each language; costs of a batch apportioned to its rows, at least one each."""
    b = batches(table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars"), 8, "doc_id", "lang")
    per = b.groupBy("lang", "batch").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    per = per.withColumn("share", F.greatest(F.lit(1), F.round(F.col("chars") / F.col("n")).cast("long")))
    return per.groupBy("lang").agg(F.count("*").alias("n_batches"), F.sum("n").alias("n_rows"), F.sum("chars").alias("n_chars"), F.sum("share").alias("sum_share"), F.round(F.avg("n"), 2).alias("avg_batch"))


def resume_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resumed stage: finished rows are reused, the others computed, and both put together."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    done = table(spark, sf_dir, "labels").select("doc_id", F.lit("reused").alias("how"))
    reused = docs.join(done, "doc_id")
    fresh = docs.join(done, "doc_id", "left_anti").withColumn("how", F.lit("computed"))
    return reused.unionByName(fresh).groupBy("lang", "how").agg(F.count("*").alias("n"))


def batch_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose returned ids differ from the requested ones fail as a whole, with the numbers missing and extra."""
    asked = table(spark, sf_dir, "labels").select("doc_id", F.floor(F.col("doc_id") / 40).alias("batch"))
    back = asked.where(_h("doc_id", "lost", 60) > 0).unionByName(asked.where(_h("doc_id", "new", 90) == 0).withColumn("doc_id", F.col("doc_id") + 1_000_000_000_000))
    j = asked.withColumn("q", F.lit(1)).join(back.withColumn("r", F.lit(1)), ["batch", "doc_id"], "full_outer")
    g = j.groupBy("batch").agg(F.count_if(F.col("r").isNull()).alias("n_missing"), F.count_if(F.col("q").isNull()).alias("n_extra"))
    return g.withColumn("failed", (F.col("n_missing") + F.col("n_extra")) > 0)


QUERIES = {
    f.__name__: f
    for f in (review_overlay, auto_review, artifact_gate, promote_disjoint, judge_delta, pair_audit, four_run_audit, presence_audit, benchmark_comparison, microbatch_metrics, resume_union, batch_reconciliation)
}


def _reasons(text: str) -> str:
    return f"""CASE WHEN coalesce(trim(regexp_replace({text}, '\\s+', ' ', 'g')), '') = '' THEN ['missing candidate text'] ELSE list_filter([
      CASE WHEN regexp_matches({text}, '…|â€¦|\\.\\.\\.') THEN 'contains ellipsis/truncation artifact' END,
      CASE WHEN regexp_matches({text}, '\\|\\s*---|\\|\\s*Beschreibung\\s*\\|') THEN 'contains markdown table artifact' END,
      CASE WHEN regexp_matches({text}, '(?i)\\*\\*(Hinweis|Achtung|Wichtig):\\*\\*') THEN 'contains note label promoted as content' END,
      CASE WHEN regexp_matches({text}, '(?i)Verwenden Sie dazu \\*\\*[^*]+:\\*\\*\\.') THEN 'contains note label misused as shortcut' END], lambda x: x IS NOT NULL) END"""


_JUDGED = f"""WITH {CONV_SQL},
j AS (SELECT *, CASE WHEN raw <= 10 THEN raw * 10 ELSE raw END AS score FROM (SELECT *, {_hs('conv_id', 'judge', 101)} AS raw, CASE WHEN {_hs('conv_id', 'decision', 4)} > 0 THEN 'approve' ELSE 'reject' END AS decision FROM c)),
a AS (SELECT *, {_reasons('answer')} AS art FROM j),
b AS (SELECT *, decision = 'approve' AND len(art) = 0 AND score < 70 AS low FROM a),
r AS (SELECT *, CASE WHEN len(art) > 0 OR low THEN 'reject' ELSE decision END AS final_decision,
             list_sort(list_distinct(art || CASE WHEN low THEN ['approve decision below minimum quality score threshold'] ELSE [] END)) AS reasons FROM b),
v AS (SELECT *, CASE WHEN final_decision = 'approve' AND len(reasons) = 0 THEN 'codex_reviewed' ELSE 'rejected' END AS review_status FROM r)"""
_RUN = lambda i: f"(SELECT doc_id, {_hs('doc_id', 'task', 5)} AS task, {_hs('doc_id', f'run{i}', 101)} AS score FROM labels)"
_D = lambda s: f"CASE WHEN {s} >= 40 THEN 'approve' ELSE 'reject' END"
_PAIR = f"WITH j AS (SELECT a.doc_id, a.task, a.score AS s1, b.score AS s2, {_D('a.score')} AS d1, {_D('b.score')} AS d2 FROM {_RUN(1)} a JOIN {_RUN(2)} b USING (doc_id))"

ORACLES = {
    "review_overlay": f"""WITH l AS (SELECT doc_id, quality::INT AS quality, toxic::INT AS toxic, {_hs('doc_id', 'overlay', 10)} AS k FROM labels),
        r AS (SELECT doc_id, CASE WHEN k = 1 THEN 1 - quality ELSE quality END AS quality, toxic FROM l WHERE k <> 0 UNION ALL SELECT doc_id + 1000000000000, quality, toxic FROM l WHERE k = 2)
        SELECT CASE WHEN r.doc_id IS NULL THEN 'missing' WHEN l.doc_id IS NULL THEN 'extra' WHEN l.quality IS NOT DISTINCT FROM r.quality AND l.toxic IS NOT DISTINCT FROM r.toxic THEN 'merged' ELSE 'conflict' END AS state, count(*) AS n
        FROM l FULL JOIN r ON l.doc_id = r.doc_id GROUP BY 1""",
    "auto_review": f"{_JUDGED} SELECT conv_id, final_decision, review_status, array_to_string(reasons, '; ') AS reasons FROM v",
    "artifact_gate": f"""SELECT lang, coalesce(reason, 'none') AS reason, count(*) AS n FROM
        (SELECT lang, unnest(CASE WHEN len(r) = 0 THEN [NULL] ELSE r END) AS reason FROM (SELECT lang, {_reasons('text')} AS r FROM documents)) GROUP BY ALL""",
    "promote_disjoint": f"""{_JUDGED}, p AS (SELECT conv_id // 10 AS chunk, {_hs('conv_id', 'split', 7)} = 0 AS is_eval FROM v WHERE review_status = 'codex_reviewed')
        SELECT chunk, count(*) FILTER (WHERE NOT is_eval) AS n_train, count(*) FILTER (WHERE is_eval) AS n_eval FROM p GROUP BY chunk HAVING n_train > 0 AND n_eval > 0""",
    "judge_delta": f"""{_PAIR} SELECT task, count(*) AS n, count(*) FILTER (WHERE d1 <> d2) AS n_changed, count(*) FILTER (WHERE s2 > s1) AS n_improved,
        count(*) FILTER (WHERE s2 < s1) AS n_worsened, count(*) FILTER (WHERE s2 = s1) AS n_same, round(avg(s2 - s1), 2) AS mean_delta FROM j GROUP BY task""",
    "pair_audit": f"""{_PAIR}, t AS (SELECT unnest([CASE WHEN task = 1 THEN 'focus_task' END, CASE WHEN d1 <> d2 THEN 'decision_disagreement' END, CASE WHEN abs(s2 - s1) >= 20 THEN 'high_score_delta' END]) AS tag, d1 || '->' || d2 AS pair FROM j)
        SELECT tag, pair, count(*) AS n FROM t WHERE tag IS NOT NULL GROUP BY ALL""",
    "four_run_audit": f"""WITH j AS (SELECT a.doc_id, a.task, [a.score, b.score, c.score, d.score] AS s FROM {_RUN(1)} a JOIN {_RUN(2)} b USING (doc_id) JOIN {_RUN(3)} c USING (doc_id) JOIN {_RUN(4)} d USING (doc_id)),
        k AS (SELECT doc_id, task, len(list_filter(s, lambda x: x >= 40)) AS v, list_max(s) - list_min(s) AS spread FROM j),
        q AS (SELECT doc_id, task, CASE v WHEN 4 THEN 'stable_approve' WHEN 0 THEN 'stable_reject' WHEN 2 THEN 'split' WHEN 3 THEN 'one_rejects' ELSE 'one_approves' END AS class, spread FROM k)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY class, task ORDER BY spread DESC, doc_id) AS rank FROM q) WHERE rank <= 3""",
    "presence_audit": f"""WITH p AS (SELECT doc_id, list_filter([{', '.join(f"CASE WHEN {_hs('doc_id', f'gone{i}', 5)} > 0 THEN 'v{i}' END" for i in range(1, 5))}], lambda x: x IS NOT NULL) AS r FROM labels)
        SELECT array_to_string(r, ',') AS runs, count(*) AS n FROM p WHERE len(r) > 0 GROUP BY 1""",
    "benchmark_comparison": f"""WITH a AS (SELECT task, count(*) FILTER (WHERE score >= 40) AS approved_ref, round(count(*) FILTER (WHERE score >= 40) / count(*), 4) AS rate_ref, round(avg(score), 2) AS score_ref FROM {_RUN(1)} GROUP BY task),
        b AS (SELECT task, count(*) FILTER (WHERE score >= 40) AS approved_cand, round(count(*) FILTER (WHERE score >= 40) / count(*), 4) AS rate_cand, round(avg(score), 2) AS score_cand FROM {_RUN(2)} GROUP BY task)
        SELECT *, approved_cand - approved_ref AS approved_delta, round(score_cand - score_ref, 4) AS score_delta FROM a FULL JOIN b USING (task)""",
    "microbatch_metrics": """WITH b AS (SELECT lang, n_chars, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 8 AS batch FROM documents),
        p AS (SELECT lang, batch, count(*) AS n, sum(n_chars) AS chars, greatest(1, round(sum(n_chars) / count(*))::BIGINT) AS share FROM b GROUP BY ALL)
        SELECT lang, count(*) AS n_batches, sum(n)::BIGINT AS n_rows, sum(chars)::BIGINT AS n_chars, sum(share)::BIGINT AS sum_share, round(avg(n), 2) AS avg_batch FROM p GROUP BY lang""",
    "resume_union": "SELECT lang, CASE WHEN l.doc_id IS NULL THEN 'computed' ELSE 'reused' END AS how, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL",
    "batch_reconciliation": f"""WITH a AS (SELECT doc_id, doc_id // 40 AS batch, {_hs('doc_id', 'lost', 60)} AS lost, {_hs('doc_id', 'new', 90)} AS new FROM labels)
        SELECT batch, count(*) FILTER (WHERE lost = 0) AS n_missing, count(*) FILTER (WHERE new = 0) AS n_extra, (count(*) FILTER (WHERE lost = 0 OR new = 0)) > 0 AS failed FROM a GROUP BY batch""",
}
