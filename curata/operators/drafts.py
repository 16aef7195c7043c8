"""Draft cases from chunks: up to five kinds of questions and answers for each chunk, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions import text as tx
from curata.functions.hashing import stable_hash

TASKS = ["faq_direct_answer", "step_by_step", "troubleshooting", "clarification", "uncertainty_escalation"]


def _draft(task: str, ok: Column, question: Column, answer: Column, score: Column, reason: Column) -> Column:
    """A draft, or null where it isn't to be made or its answer has an artifact."""
    made = F.struct(F.lit(task).alias("task_type"), question.alias("user_message"), answer.alias("assistant_message"), score.cast("int").alias("score"), reason.alias("selection_reason"))
    return F.when(F.coalesce(ok, F.lit(False)) & ~F.coalesce(tx.has_blocking_artifact(answer), F.lit(True)), made)


def _cat(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _plus(base: int, *terms: tuple[Column, int]) -> Column:
    total = F.lit(base)
    for condition, points in terms:
        total = total + F.when(F.coalesce(condition, F.lit(False)), points).otherwise(0)
    return total


def _first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def with_parts(chunks: DataFrame) -> DataFrame:
    """``chunks`` with what several drafts need, each computed once: a column at a time, so that expressions stay small."""
    limited = lambda col: _first(F.filter(col, lambda s: s.rlike(tx.LIMITATION)))
    df = chunks.withColumns({"_title": tx.strip_markdown(F.col("section_title")), "_cuts": tx.shortcuts(F.col("content")), "_sent": tx.sentences(F.col("content")), "_bul": tx.bullets(F.col("content")), "_num": tx.numbered_steps(F.col("content")), "_sum": tx.clean_line(F.coalesce("summary", F.lit("")))})
    df = df.withColumn("_clean", tx.without_artifacts(F.col("_sent")))
    df = df.withColumn("_distinct", tx.first_distinct(F.col("_clean"), F.col("_sum"), 4))
    six = F.slice("_clean", 1, 6)
    df = df.withColumns({"_d3": F.slice("_distinct", 1, 3), "_d4": F.slice("_distinct", 1, 4), "_limit6": limited(six), "_act": F.filter(six, lambda s: s.rlike(tx.ACTION))})
    df = df.withColumn("_limit4", limited(F.col("_d4")))
    labels = F.transform("_bul", lambda b: F.trim(F.split_part(F.split_part(F.regexp_replace(b, r"(?s)^.*? - ", ""), F.lit(","), F.lit(1)), F.lit(";"), F.lit(1))))
    labels = F.filter(labels, lambda x: F.length(x).between(3, 80) & ~x.rlike(tx.ACTION) & ~x.rlike(tx.OPTION_PREFIX))
    df = df.withColumn("_labels", labels)
    low = F.lower("section_title")
    # fixed values: the choices for two well-known topics
    options = (
        F.when(F.size("_labels") >= 3, F.slice("_labels", 1, 4))
        .when(low.contains("texterkennung"), F.array(*map(F.lit, ["Bilddatei", "geoeffnetes PDF", "aktuelles Fenster oder Bildschirm", "Kamera oder Scanner"])))
        .when(low.contains("cursor"), F.array(*map(F.lit, ["PC Cursor", "JAWS Cursor", "unsichtbaren Cursor"])))
        .otherwise(F.slice("_cuts", 1, 3))
    )
    return df.withColumn("_options", options)


def drafts(chunks: DataFrame) -> DataFrame:
    """One row for each draft: the chunk's ids, ``task_type``, messages, ``score`` and ``selection_reason``."""
    df = with_parts(chunks)
    kind, title, cut = F.col("chunk_type"), F.col("_title"), _first(F.col("_cuts"))
    has_cut = F.size("_cuts") > 0
    calm = kind.isin("concept", "reference")
    no_cut = lambda answer: has_cut & ~answer.contains(cut)
    key = lambda answer: _cat(answer, " Wichtige Tastenkombination: **", cut, "**.")
    steered = F.coalesce(F.col("content").rlike(tx.LIMITATION), F.lit(False))

    turn = F.pmod(stable_hash(F.concat("chunk_id", F.lit("::faq"))), F.lit(3))
    # fixed values: the wording of questions and answers
    asks = [_cat("Wofuer ist ", title, " in JAWS gedacht?"), _cat("Wie beschreibt die JAWS-Dokumentation ", title, "?"), _cat("Was sollte ich in JAWS zu ", title, " wissen?")]
    base = tx.join_snippets(F.slice("_d3", 1, 2), 360)
    faq = _draft(
        "faq_direct_answer", (F.size("_d3") > 0) & (base != "") & ~base.endswith(":"),
        F.when(turn == 0, asks[0]).when(turn == 1, asks[1]).otherwise(asks[2]), F.when(no_cut(base) & calm, key(base)).otherwise(base),
        _plus(46, (F.col("char_count") <= 1500, 8), (calm, 12), (kind == "warning", 4), (has_cut & calm, 6)), _cat("faq:", kind, ":", F.when(has_cut, "shortcut").otherwise("no_shortcut")),
    )

    capital = F.transform(F.slice("_bul", 1, 5), lambda b: F.concat(F.upper(F.substring(b, 1, 1)), F.substring(b, 2, 1 << 30)))
    numbered, listed = F.size("_num") > 0, F.size("_bul") > 0
    steps = F.when(numbered, F.slice("_num", 1, 5)).when(listed, capital).otherwise(F.slice("_sent", 1, 5))
    step = _draft(
        "step_by_step", ((kind == "procedure") | F.col("contains_steps")) & (F.size(steps) >= 3), _cat("Wie gehe ich bei ", title, " in JAWS Schritt fuer Schritt vor?"),
        F.array_join(F.transform(steps, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), s)), "\n"),
        _plus(44, (kind == "procedure", 20), (F.col("contains_steps"), 12), (has_cut, 6)), _cat("step:", kind, ":", F.when(numbered, "numbered").when(listed, "bullets").otherwise("sentences")),
    )

    limit, act = F.col("_limit6"), F.col("_act")
    pressing = kind.isin("warning", "procedure")
    lead = F.when(limit.isNotNull(), F.array(limit)).otherwise(F.array().cast("array<string>"))
    chosen = tx.distinct_by_lower(F.concat(lead, act), 2)
    told = _cat("Laut Dokumentation sollten Sie Folgendes pruefen oder beachten: ", F.array_join(chosen, " "))
    trouble = _draft(
        "troubleshooting", (pressing | F.lower("content").rlike(tx.LIMITATION)) & (pressing | limit.isNotNull()) & ((F.size(act) > 0) | (kind != "concept")) & (F.size(chosen) > 0),
        _cat("Ich komme bei ", title, " in JAWS nicht weiter. Was sollte ich laut Dokumentation pruefen oder tun?"), F.when(no_cut(told) & (F.size(act) > 0), key(told)).otherwise(told),
        _plus(42, (pressing, 16), (limit.isNotNull(), 10), (F.size(act) > 0, 8), (has_cut & (F.size(act) > 0), 4)), _cat("troubleshooting:", kind, ":", F.when(limit.isNotNull(), "limitation").otherwise("actionable")),
    )

    options, low = F.col("_options"), F.lower("section_title")
    n = F.size(options)
    joined = _cat(F.array_join(F.slice(options, 1, F.greatest(n - 1, F.lit(0))), ", "), " oder ", F.get(options, n - 1))
    clarify = _draft(
        "clarification", (F.col("contains_list") | low.contains("texterkennung") | low.contains("cursor")) & (n >= 3),
        F.when(low.contains("texterkennung"), "Wie nutze ich die Texterkennung in JAWS?").when(low.contains("cursor"), "Welchen Cursor sollte ich in JAWS verwenden?").otherwise(_cat("Ich brauche Hilfe zu ", title, " in JAWS.")),
        _cat("Geht es Ihnen um ", joined, "?"), _plus(36, (F.col("contains_list"), 18), (n >= 4, 8)), _cat("clarification:options_", n.cast("string")),
    )

    edge = F.col("_limit4")
    doubt = _draft(
        "uncertainty_escalation", ((kind == "warning") | steered) & (F.size("_d4") > 0) & (edge.isNotNull() | (kind == "warning")),
        _cat("Kann ich mich bei ", title, " in JAWS allgemein darauf verlassen, dass das immer gleich unterstuetzt wird?"),
        _cat("Die Quelle belegt hier keine allgemeine Zusage. ", F.coalesce(edge, _first(F.col("_d4"))), " Pruefen Sie deshalb den konkreten Kontext in JAWS oder in der zugehoerigen Dokumentation, statt eine allgemeine Unterstuetzung anzunehmen."),
        _plus(42, (kind == "warning", 18), (edge.isNotNull(), 14)), _cat("uncertainty:", kind, ":", F.when(edge.isNotNull(), "limitation").otherwise("warning_only")),
    )

    made = df.select("doc", "chunk_id", "section_id", "section_title", "chunk_type", F.substring("content", 1, 1400).alias("source_excerpt"), "source_span", F.explode(F.array_compact(F.array(faq, step, trouble, clarify, doubt))).alias("d"))
    return made.select(*made.columns[:-1], "d.*")
