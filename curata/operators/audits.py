"""Audits of several judge runs over the same jobs, run summaries and their comparison.

A run is a pair of DataFrames: judgements (``job_id``, ``task_type``, ``decision``, ``quality_score``)
and reviewed rows (``job_id``, ``task_type``, ``answer``). The first run is the reference, the others are candidates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Runs = Mapping[str, tuple[DataFrame, DataFrame]]
REFERENCE = "reference"


def _wide(runs: Runs, how: str) -> DataFrame:
    """A row for each job with each run's decision (d), score (s), answer (a) and whether it judged the job (j)."""
    sides = []
    for name, (judged, reviewed) in runs.items():
        text = F.trim(F.coalesce("answer", F.lit("")))
        j = judged.select("job_id", F.coalesce(F.nullif(F.col("decision"), F.lit("")), F.lit("missing")).alias(f"d_{name}"), F.col("quality_score").cast("int").alias(f"s_{name}"), F.col("task_type").alias(f"t_{name}"), F.lit(True).alias(f"j_{name}"))
        sides.append(j.join(reviewed.select("job_id", text.alias(f"a_{name}")), "job_id", "inner" if how == "inner" else "full_outer"))
    wide = reduce(lambda x, y: x.join(y, "job_id", how), sides)
    task = F.coalesce(*(F.col(f"t_{n}") for n in runs), F.lit("unknown"))
    wide = wide.withColumns({f"d_{n}": F.coalesce(f"d_{n}", F.lit("missing")) for n in runs})
    return wide.withColumn("task_type", task).drop(*(f"t_{n}" for n in runs))


def _settled(d: Column) -> Column:
    return d.isin("approve", "reject")


class _Case:
    """Expressions over a wide row."""

    def __init__(self, names: Sequence[str]):
        self.ref, *self.others = names
        self.names = names
        self.d = {n: F.col(f"d_{n}") for n in names}
        scores = F.array_compact(F.array(*(F.col(f"s_{n}") for n in names)))
        self.scores = {n: F.col(f"s_{n}") for n in names}
        self.spread = F.when(F.size(scores) > 0, F.array_max(scores) - F.array_min(scores))
        texts = F.filter(F.array_compact(F.array(*(F.col(f"a_{n}") for n in self.others))), lambda t: t != "")
        self.same_answer = F.size(F.array_distinct(texts)) <= 1
        own = F.coalesce(F.col(f"a_{self.ref}"), F.lit(""))
        self.changed = F.exists(texts, lambda t: t != own)
        self.votes = F.array_distinct(F.filter(F.array(*(self.d[n] for n in self.others)), lambda d: d != "missing"))

    def differs(self, n: str) -> Column:
        return _settled(self.d[self.ref]) & _settled(self.d[n]) & (self.d[n] != self.d[self.ref])


def classify(case: _Case) -> Column:
    """Why the runs disagree, or how far they agree. The names of the classes, as reports carry them."""
    ref, vote = case.d[case.ref], F.get(case.votes, F.lit(0))
    return (
        F.when(F.size(case.votes) > 1, F.when(case.same_answer, "same_answer_judge_instability").otherwise("answer_and_judge_shift"))
        .when(~_settled(ref), "insufficient_codex_reference")
        .when(F.size(case.votes) == 0, "missing_openrouter_signal")
        .when(ref != vote, F.when(case.changed, "answer_quality_gain_or_loss").otherwise("judge_calibration_conflict"))
        .when(case.spread >= 20, "reasoning_drift_same_decision")
        .otherwise("stable_borderline")
    )


def borderline(runs: Runs, focus: Sequence[str], spread: int = 20, approve_most: int = 80, reject_least: int = 60, per_task: int = 3) -> DataFrame:
    """Cases that all runs judged and answered, in focus tasks, that some tag singles out; a task with too few gets its most telling others.

    One row a case: ``tags`` (ordered), ``score_spread``, ``hint`` (see :func:`classify`), ``same_answer``, ``changed``, and the runs' decisions and scores.
    """
    names = list(runs)
    case = _Case(names)
    wide = _wide(runs, "inner")
    either = lambda test: reduce(or_, (F.coalesce(test(n), F.lit(False)) for n in names))
    score = lambda n: F.coalesce(case.scores[n], F.lit(0))
    settled = F.array_distinct(F.filter(F.array(*(case.d[n] for n in case.others)), _settled))
    tags = {
        **{f"decision_mismatch_vs_codex:{n}": case.differs(n) for n in case.others},
        "openrouter_internal_decision_disagreement": F.size(settled) > 1,
        f"high_score_spread>={spread}": F.coalesce(case.spread >= spread, F.lit(False)),
        f"borderline_approve<={approve_most}": either(lambda n: (case.d[n] == "approve") & (score(n) <= approve_most)),
        f"borderline_reject>={reject_least}": either(lambda n: (case.d[n] == "reject") & (score(n) >= reject_least)),
    }
    in_focus = F.col("task_type").isin(list(focus))
    other_tags = F.array_compact(F.array(*(F.when(v, k) for k, v in tags.items())))
    # how telling a case is: disagreements, then spread, then how near a score is to its border
    disagreements = reduce(add, (case.differs(n).cast("int") for n in case.others)) + (F.size(F.array_distinct(F.array(*(case.d[n] for n in case.others)))) > 1).cast("int")
    distance = F.array_min(F.array_compact(F.array(*(F.when(case.d[n] == "approve", F.abs(case.scores[n] - approve_most)).when(case.d[n] == "reject", F.abs(case.scores[n] - reject_least)) for n in names))))
    found = wide.where(in_focus).withColumns({"_tags": other_tags, "score_spread": case.spread, "hint": classify(case), "same_answer": case.same_answer, "changed": case.changed, "_much": disagreements, "_far": F.coalesce(distance, F.lit(999))})
    found = found.withColumn("_primary", F.size("_tags") > 0)
    by = Window.partitionBy("task_type")
    rank = F.row_number().over(Window.partitionBy("task_type", "_primary").orderBy(F.desc("_much"), F.desc(F.coalesce("score_spread", F.lit(0))), "_far", "job_id"))
    ranked = found.withColumns({"_rank": rank, "_have": F.count_if("_primary").over(by)})
    kept = ranked.where(F.col("_primary") | (F.col("_rank") <= per_task - F.col("_have")))
    whole = F.concat(F.array(F.concat(F.lit("focus_task_type:"), "task_type")), "_tags", F.when(F.col("_primary"), F.array().cast("array<string>")).otherwise(F.array(F.lit("task_coverage_backfill"))))
    place = F.array_position(F.array(*map(F.lit, focus)), F.col("task_type"))
    return kept.select("job_id", "task_type", place.alias("place"), whole.alias("tags"), "score_spread", "hint", "same_answer", "changed", *(f"d_{n}" for n in names), *(f"s_{n}" for n in names))


def patterns(cases: DataFrame, names: Sequence[str], spread: int = 20) -> DataFrame:
    """(``run``, ``pattern``, ``n``) of selected cases: how each candidate differs from the reference, and how the candidates agree ('all')."""
    ref, *others = names
    d = lambda n: F.col(f"d_{n}")
    facts = []
    for n in others:
        jump = F.abs(F.col(f"s_{n}") - F.col(f"s_{ref}")) >= spread
        for pattern, test in (("approve_when_codex_rejects", (d(ref) == "reject") & (d(n) == "approve")), ("reject_when_codex_approves", (d(ref) == "approve") & (d(n) == "reject")), ("same_decision_high_score_delta", (d(ref) == d(n)) & _settled(d(n)) & jump)):
            facts.append(F.when(test, F.struct(F.lit(n).alias("run"), F.lit(pattern).alias("pattern"))))
    every = F.array(*map(d, others))
    count = lambda v: F.size(F.filter(every, lambda x: x == v))
    stable = F.size(F.array_distinct(every)) == 1
    for pattern, test in (("stable_across_openrouter_versions", stable), ("openrouter_internal_disagreement", ~stable), ("two_approve_one_reject", (count("approve") == 2) & (count("reject") == 1)), ("two_reject_one_approve", (count("reject") == 2) & (count("approve") == 1))):
        facts.append(F.when(test, F.struct(F.lit("all").alias("run"), F.lit(pattern).alias("pattern"))))
    return cases.select(F.explode(F.array_compact(F.array(*facts))).alias("f")).groupBy("f.run", "f.pattern").agg(F.count("*").alias("n"))


def clarification(runs: Runs, task: str = "clarification", supplemental: Runs | None = None) -> DataFrame:
    """Cases of one task that any run has, with each run's decision ('missing' if none) and how they disagree; supplemental runs beside."""
    only = lambda df: df.where(F.col("task_type") == task)
    names = list(runs)
    ref, v1, v2, v3 = names
    wide = _wide({n: (only(j), only(r)) for n, (j, r) in runs.items()}, "full_outer")
    case = _Case(names)
    d = case.d
    agreed = (F.size(case.votes) <= 1) & ((F.size(case.votes) == 0) | F.array_contains(case.votes, d[ref]))
    hint = (
        F.when(agreed, "stable_alignment")
        .when((d[v1] == d[v2]) & (d[v3] != d[v2]) & (d[v3] != "missing"), "v3_outlier")
        .when((d[ref] != "missing") & ~F.array_contains(case.votes, d[ref]), "systematic_openrouter_disagreement")
        .otherwise("mixed_signal")
    )
    out = wide.select("job_id", *(f"d_{n}" for n in names), hint.alias("hint"), *(F.coalesce((d[n] != d[ref]) & (d[n] != "missing") & (d[ref] != "missing"), F.lit(False)).alias(f"differs_{n}") for n in case.others))
    for n, (judged, _) in (supplemental or {}).items():
        out = out.join(only(judged).select("job_id", F.col("decision").alias(f"also_{n}")), "job_id", "left")
    return out


def run_summary(outputs: DataFrame, reviewed: DataFrame, judged: DataFrame) -> DataFrame:
    """One row: rows of each artifact, rows without source records, approvals with their rate, and the judge's decisions and average score."""
    bare = F.count_if(F.coalesce(F.size("source_records"), F.lit(0)) <= 0)
    o = outputs.agg(F.count("*").alias("output_rows"), bare.alias("outputs_without_sources"), F.count_if(F.col("record_type") == "sft_sample").alias("sft_rows"), F.count_if(F.col("record_type") == "eval_case").alias("eval_rows"))
    r = reviewed.agg(F.count("*").alias("reviewed_rows"), bare.alias("reviewed_without_sources"), F.count_if(F.col("review_status") == "codex_reviewed").alias("approved_jobs"), F.count_if(F.col("review_status") == "rejected").alias("rejected_jobs"))
    j = judged.agg(F.count("*").alias("judge_rows"), bare.alias("judged_without_sources"), F.count_if(F.col("decision") == "approve").alias("approve_decisions"), F.count_if(F.col("decision") == "reject").alias("reject_decisions"), F.round(F.avg(F.col("quality_score").cast("int")), 2).alias("average_quality_score"))
    rate = F.round(F.try_divide("approved_jobs", "reviewed_rows"), 4)
    lost = F.col("outputs_without_sources") + F.col("reviewed_without_sources") + F.col("judged_without_sources")
    return o.crossJoin(r).crossJoin(j).withColumns({"approval_rate": rate, "sources_ok": lost == 0})  # a row each


DELTAS = "output_rows reviewed_rows approved_jobs rejected_jobs approval_rate average_quality_score".split()


def benchmark_name(reference: dict | None, candidate: dict | None) -> str:
    """The benchmark that both runs are of; an error if a run has none, plays another role or is of another benchmark."""
    for found, role in ((reference, "reference"), (candidate, "candidate")):
        if not found or not str(found.get("name") or "").strip():
            raise ValueError(f"the {role} run belongs to no benchmark")
        if found.get("role") != role:
            raise ValueError(f"the {role} run plays the role {found.get('role')!r}")
    if reference["name"] != candidate["name"]:
        raise ValueError(f"two benchmarks: {reference['name']} and {candidate['name']}")
    return reference["name"]


def benchmark_of(name: str | None, role: str | None, profile_set: str | None, promote: bool = False) -> dict[str, str] | None:
    """What marks a run as one of a benchmark: name and role come together, need a profile set and exclude promotion."""
    if not name and not role:
        return None
    for ok, what in ((bool(name and role), "a benchmark has a name and a role"), (bool(profile_set), "a benchmark run needs a profile set"), (not promote, "a benchmark run promotes nothing")):
        if not ok:
            raise ValueError(what)
    return {"name": name, "role": role, "profile_set": profile_set}


def compare(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """(``what``, ``reference``, ``candidate``, ``delta``) of two run summaries; a null on either side has no delta."""
    long = lambda df, n: df.select(F.explode(F.array(*(F.struct(F.lit(k).alias("what"), F.col(k).cast("double").alias(n)) for k in DELTAS))).alias("x")).select("x.*")
    return long(reference, "reference").join(long(candidate, "candidate"), "what").withColumn("delta", F.round(F.col("candidate") - F.col("reference"), 4))


STAGE_COUNTS = "selected_jobs completed_jobs failed_jobs total_elapsed_ms total_retry_attempts".split()


def stage_deltas(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """Stages of two runs (``stage`` and ``STAGE_COUNTS``) side by side: deltas, null where a side lacks a number, and whether they ran over as many jobs."""
    c = candidate.select("stage", *(F.col(k).alias(f"_{k}") for k in STAGE_COUNTS))
    return reference.join(c, "stage", "left").select("stage", *((F.col(f"_{k}") - F.col(k)).alias(f"{k}_delta") for k in STAGE_COUNTS[1:]), F.col("selected_jobs").eqNullSafe(F.col("_selected_jobs")).alias("same_jobs"))


def run_delta(before: DataFrame, after: DataFrame, focus: Sequence[str] = ()) -> DataFrame:
    """The jobs that two judge runs decide or score differently; outside ``focus`` tasks (if given) only other decisions count. Both must have judged the same jobs."""
    a = before.select("job_id", "task_type", F.col("decision").alias("old_decision"), F.col("quality_score").alias("old_score"))
    b = after.select("job_id", F.col("decision").alias("new_decision"), F.col("quality_score").alias("new_score"))
    for x, y, what in ((a, b, "missing"), (b, a, "extra")):
        if odd := [r[0] for r in x.join(y, "job_id", "left_anti").select("job_id").orderBy("job_id").limit(10).collect()]:
            raise ValueError(f"{what} jobs: {', '.join(map(str, odd))}")
    j = a.join(b, "job_id").withColumn("delta", F.col("new_score") - F.col("old_score"))
    other = ~F.col("old_decision").eqNullSafe(F.col("new_decision"))
    scored = (F.col("delta") != 0) & (F.col("task_type").isin(list(focus)) if focus else F.lit(True))
    return j.where(other | F.coalesce(scored, F.lit(False)))


def pair(reference: tuple[DataFrame, DataFrame], candidate: tuple[DataFrame, DataFrame], focus: Sequence[str], least_delta: int = 20) -> DataFrame:
    """Cases that both runs judged and answered and that some tag singles out: a focus task, another decision, a score far off; with both answers."""
    names = ("reference", "candidate")
    wide = _wide(dict(zip(names, (reference, candidate), strict=True)), "inner")
    delta = F.col("s_candidate") - F.col("s_reference")
    tags = F.array_compact(
        F.array(
            F.when(F.col("task_type").isin(list(focus)), F.concat(F.lit("focus_task_type:"), "task_type")),
            F.when(F.col("d_reference") != F.col("d_candidate"), "decision_disagreement"),
            F.when(F.abs(delta) >= least_delta, f"high_score_delta>={least_delta}"),
        )
    )
    return wide.withColumns({"tags": tags, "delta": delta, "decisions": F.concat_ws("->", "d_reference", "d_candidate")}).where(F.size("tags") > 0).select("job_id", "task_type", "tags", "delta", "decisions", F.col("a_reference").alias("reference_answer"), F.col("a_candidate").alias("candidate_answer"))


def pair_counts(cases: DataFrame) -> DataFrame:
    """(``what``, ``key``, ``n``) of a pair audit: its tags, tasks and pairs of decisions."""
    facts = F.concat(F.transform("tags", lambda t: F.struct(F.lit("tag").alias("what"), t.alias("key"))), F.array(F.struct(F.lit("task_type").alias("what"), F.col("task_type").alias("key")), F.struct(F.lit("decisions").alias("what"), F.col("decisions").alias("key"))))
    return cases.select(F.explode(facts).alias("f")).groupBy("f.what", "f.key").agg(F.count("*").alias("n"))
