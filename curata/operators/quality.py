"""Quality of chat data: canonical rows, flags of stock phrases, faithfulness to sources, cases to look at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.text import truthy, words

# Stock openings, leftovers and marks of provisional sources; least overlap by task.
STARTERS = ("Dafuer gibt der vorliegende Abschnitt keine allgemeine Zusage.", "Geht es Ihnen um", "Die Dokumentation empfiehlt fuer diesen Fall:")
LEFTOVERS = ("Verwenden Sie dazu **Hinweis:**", "Verwenden Sie dazu **Tipp:**", "Die Dokumentation empfiehlt fuer diesen Fall: Hinweis:", "Die Dokumentation empfiehlt fuer diesen Fall: Tipp:")
PROVISIONAL = ("stub", "fixture")
LEAST_OVERLAP = {"faq_direct_answer": 0.35, "troubleshooting": 0.22, "step_by_step": 0.22, "clarification": 0.10, "uncertainty_escalation": 0.10}
ELSE_OVERLAP, MOST_NOVEL = 0.2, 0.75
NOVELTY_TASKS = ("faq_direct_answer", "troubleshooting", "step_by_step")


def canonical(rows: DataFrame, meta: DataFrame | None, key: str, strings: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """Rows with their sidecar: for each column the first value that is filled, of the sidecar, the row, and the row's own ``meta``.

    A sidecar that lacks a row or has an id twice is an error; no sidecar is none.
    """
    j = rows
    if meta is not None:
        twice = [r[0] for r in meta.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key).limit(10).collect()]
        gone = [r[0] for r in rows.join(meta, key, "left_anti").select(key).limit(10).collect()]
        for ids, what in ((twice, "repeated in the sidecar"), (gone, "missing from the sidecar")):
            if ids:
                raise ValueError(f"{what}: {', '.join(sorted(map(str, ids)))}")
        j = rows.join(meta.select(key, F.struct(*(c for c in meta.columns if c != key)).alias("_side")), key, "left")
    own = rows.schema["meta"].dataType.names if "meta" in rows.columns else []

    def first(name: str, good) -> Column:
        found = [F.col(f"_side.{name}")] if meta is not None and name in meta.columns else []
        found += [F.col(name)] if name in rows.columns else []
        found += [F.col(f"meta.{name}")] if name in own else []
        return F.coalesce(*map(good, found), F.lit(None)) if found else F.lit(None).cast("string")

    filled = lambda c: F.when(F.size(c) > 0, c)
    kept = [c for c in rows.columns if c not in (*strings, *lists, "meta")]
    return j.select(*kept, *(first(c, truthy).alias(c) for c in strings), *(first(c, filled).alias(c) for c in lists))


def phrase_flags(answer: Column, *origin: Column) -> Column:
    """Which stock opening an answer has, which leftovers it holds, whether it ends cut, and whether its origin is provisional."""
    low = F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in origin))) if origin else F.lit("")
    found = [F.when(answer.startswith(s), f"opening: {s}") for s in STARTERS] + [F.when(answer.contains(s), f"leftover: {s}") for s in LEFTOVERS]
    found.append(F.when(answer.endswith("…") | answer.endswith("..."), "terminal_ellipsis"))
    found.append(F.when(low.contains(PROVISIONAL[0]) | low.contains(PROVISIONAL[1]), "provisional origin"))
    return F.array_compact(F.array(*found))


def faithfulness(rows: DataFrame) -> DataFrame:
    """Rows (``id``, ``task``, ``prompt``, ``answer``, ``source``) with the shares of the answer's words that the source has and that neither source nor prompt has, and their flags."""
    fill = lambda c: F.coalesce(F.col(c), F.lit(""))
    sets = rows.select("id", "task", fill("answer").alias("answer"), fill("source").alias("source"), words(fill("answer")).alias("a"), words(fill("source")).alias("s"), words(fill("prompt")).alias("p"))
    n = F.greatest(F.size("a"), F.lit(1))
    least = F.coalesce(*(F.when(F.col("task") == t, v) for t, v in LEAST_OVERLAP.items()), F.lit(ELSE_OVERLAP))
    m = sets.withColumns({"_overlap": F.size(F.array_intersect("a", "s")) / n, "_novel": F.size(F.array_except(F.array_except("a", "s"), F.col("p"))) / n, "threshold": least})
    flags = F.array_compact(
        F.array(
            F.when(F.col("_overlap") < F.col("threshold"), "low_lexical_overlap"),
            F.when((F.col("_novel") > MOST_NOVEL) & F.col("task").isin(*NOVELTY_TASKS), "high_novel_word_ratio"),
            F.when(F.col("answer").endswith("...") | F.col("answer").endswith("…"), "assistant_ends_with_ellipsis"),
            F.when(F.trim("source") == "", "missing_source_text"),
        )
    )
    return m.select("id", "task", F.round("_overlap", 4).alias("overlap_ratio"), F.round("_novel", 4).alias("novel_word_ratio"), F.size("a").cast("long").alias("assistant_word_count"), F.size("s").cast("long").alias("source_word_count"), "threshold", flags.alias("flags"))


def worst(metrics: DataFrame, flagged: int = 50, lowest: int = 25) -> DataFrame:
    """The flagged rows with the most flags, and the rows of the least overlap whatever their flags; ``list`` says which, a row may be in both."""
    most = metrics.where(F.size("flags") > 0).orderBy(F.desc(F.size("flags")), "overlap_ratio", "id").limit(flagged)
    return most.withColumn("list", F.lit("flagged")).unionByName(metrics.orderBy("overlap_ratio", "id").limit(lowest).withColumn("list", F.lit("lowest")))


def focus_cases(judged: DataFrame, n: int = 12) -> DataFrame:
    """Judgements that a person should see: rejects first, then step tasks, by score; untagged ones never."""
    score = F.coalesce(F.col("quality_score").cast("int"), F.lit(0))
    step, reject = F.coalesce(F.col("task_type") == "step_by_step", F.lit(False)), F.coalesce(F.col("decision") == "reject", F.lit(False))
    tags = F.array_compact(F.array(F.when(step, "priority_step_by_step"), F.when(reject, "reject"), F.when(score <= 85, "borderline_score"), F.when(F.coalesce(F.size("blocking_reasons"), F.lit(0)) > 0, "blocking_reasons_present")))
    return judged.withColumns({"score": score, "tags": tags}).where(F.size("tags") > 0).orderBy(F.desc(reject), F.desc(step), "score", "job_id").limit(n)
