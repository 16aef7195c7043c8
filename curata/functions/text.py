"""Text scalar functions as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as one class, spelt out so that every engine agrees on it.
WS = "[ \\t\\n\\r\\f\\x0B]"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it inside its own lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def truthy(col: Column) -> Column:
    """A string that is neither null nor empty, else null."""
    return F.nullif(col, F.lit(""))


def collapse(col: Column) -> Column:
    """White space runs to one space, trimmed."""
    return F.trim(F.regexp_replace(col, f"{WS}+", " "))


def normalized_key(col: Column) -> Column:
    """The key under which texts count as equal: collapsed and case-folded."""
    return F.replace(F.lower(collapse(F.coalesce(col, F.lit("")))), F.lit("ß"), F.lit("ss"))


def preview(col: Column, limit: int = 220, mark: str = "...") -> Column:
    text = collapse(col)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - len(mark)), F.lit(mark)))


def summary(col: Column, limit: int = 180) -> Column:
    """Collapsed, cut to ``limit`` characters with an ellipsis sign."""
    text = collapse(col)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit("…")))


def strip_markdown(col: Column) -> Column:
    """Links to their text, without bold and code marks, underscores to spaces."""
    text = F.regexp_replace(col, r"\[([^\]]+)\]\(([^)]+)\)", "$1")
    return collapse(F.replace(F.replace(F.replace(text, F.lit("**"), F.lit("")), F.lit("`"), F.lit("")), F.lit("_"), F.lit(" ")))


def clean_line(col: Column) -> Column:
    """Stripped of markdown, of a leading number and of dashes around."""
    text = F.regexp_replace(strip_markdown(col), r"^\d+\.\s*", "")
    return F.trim(F.btrim(collapse(text), F.lit("- ")))


def bullets(content: Column) -> Column:
    """The lines that start with ``- ``, cleaned."""
    lines = F.transform(F.split(content, "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, f"^{WS}+", ""), f"{WS}+$", ""))
    return F.transform(F.filter(lines, lambda x: x.startswith("- ")), lambda x: clean_line(F.substring(x, 3, 1 << 30)))


def sentences(content: Column) -> Column:
    """Split behind ``.``, ``!`` or ``?``; cleaned; without empty ones and bare numbers."""
    parts = F.transform(F.split(F.regexp_replace(content, f"{WS}+", " "), r"(?<=[.!?])\s+"), clean_line)
    return F.filter(parts, lambda s: (s != "") & ~s.isin("1.", "2.", "3.", "4.", "5."))


def numbered_steps(content: Column) -> Column:
    """The texts behind ``N.`` at line starts, up to the next one, cleaned."""
    found = F.regexp_extract_all(content, F.lit(r"(?s)(?:^|\n)\s*\d+\.\s*(.+?)(?=(?:\n\s*\d+\.\s)|$)"), F.lit(1))
    return F.filter(F.transform(found, clean_line), lambda s: s != "")


# Patterns of the drafts' language.
ELLIPSIS = "…|â€¦|\\.\\.\\."
TABLE_MARK = r"\|\s*---|\|\s*Beschreibung\s*\|"
LIMITATION = r"(?iuU)\b(nicht|nur|falls|wenn|unterstuetzt|unterstützt|abh[aä]ngig|m[öo]glicherweise|kann nicht|ohne|optional)\b"
ACTION = r"(?iuU)\b(druecken|drücken|waehlen|wählen|oeffnen|öffnen|aktivieren|deaktivieren|pruefen|prüfen|stellen sie sicher|wechseln|konfigurieren|verwenden|geben sie|schalten sie|bewegen sie|gehen sie|markieren|speichern)\b"
NOTE_LABEL = r"(?i)^(hinweis|achtung|wichtig)\s*:?$"
OPTION_PREFIX = r"(?iuU)^(druecken|drücken|waehlen|wählen|verwenden sie|nutzen sie|gehen sie|markieren sie|aktivieren sie|deaktivieren sie|um\b)"
STOPWORDS = """
der die das und oder ein eine einer eines einem den dem des zu in auf mit fuer für von ist sind wird werden sie ich es dass
am an im um als auch nicht nur dann wenn bei wie was welche welcher welches sich kann koennen können soll sollen laut
dokumentation hilfe jaws
""".split()


def _looks_left_over(s: Column) -> Column:
    low = F.lower(s)
    return (s == "") | s.rlike(ELLIPSIS) | s.rlike(TABLE_MARK) | s.startswith("|") | low.startswith("hinweis:") | low.startswith("achtung:") | low.startswith("wichtig:")


def is_artifact(sentence: Column) -> Column:
    """A sentence that is a leftover of markup, given cleaned or not."""
    return _looks_left_over(clean_line(sentence))


def without_artifacts(values: Column) -> Column:
    """The sentences that are no leftovers; each is cleaned once."""
    marked = F.zip_with(values, F.transform(values, clean_line), lambda s, c: F.struct(s.alias("s"), _looks_left_over(c).alias("bad")))
    return F.transform(F.filter(marked, lambda x: ~x["bad"]), lambda x: x["s"])


def support_sentences(content: Column) -> Column:
    """The sentences of a text that can support an answer."""
    return without_artifacts(sentences(content))


def has_blocking_artifact(text: Column) -> Column:
    s = clean_line(text)
    return s.rlike(ELLIPSIS) | s.rlike(TABLE_MARK)


def distinct_by_lower(values: Column, limit: int = 1 << 30) -> Column:
    """The first of each set of values that are equal in lower case, in order; at most ``limit``."""

    def of(both: Column) -> Column:
        keys = F.slice(F.array_distinct(both["low"]), 1, limit)
        return F.transform(keys, lambda k: F.get(both["as_is"], (F.array_position(both["low"], k) - 1).cast("int")))

    return bound(F.struct(values.alias("as_is"), F.transform(values, F.lower).alias("low")), of)


def first_distinct_sentences(content: Column, summary: Column, limit: int) -> Column:
    """The summary, unless the first sentence says it, and the distinct sentences that don't end in a colon."""
    return first_distinct(support_sentences(content), clean_line(F.coalesce(summary, F.lit(""))), limit)


def first_distinct(clean: Column, head: Column, limit: int) -> Column:
    """:func:`first_distinct_sentences` of sentences and a summary that are clean."""
    first = F.lower(F.coalesce(F.get(clean, F.lit(0)), F.lit("")))
    known = ~head.rlike("\\.\\.\\.|…") & (first != "") & (first.startswith(F.lower(head)) | first.contains(F.substring(F.lower(head), 1, 48)))
    lead = F.when((head != "") & ~known, F.array(head)).otherwise(F.array().cast("array<string>"))
    return distinct_by_lower(F.concat(lead, F.filter(clean, lambda s: ~s.endswith(":"))), limit)


def compact_text(col: Column) -> Column:
    """Lines stripped, one line feed at a line's end, runs of blank lines made one, trimmed."""
    lines = F.transform(F.split(F.regexp_replace(col, "\r\n?", "\n"), "\n"), lambda x: F.regexp_replace(x, f"^{WS}+|{WS}+$", ""))
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"), "^\n+|\n+$", "")


def safe_slug(col: Column) -> Column:
    """Characters that are neither letters, digits, ``.``, ``_`` nor ``-`` to ``_`` each; letters of all scripts stay."""
    return F.regexp_replace(col, r"[^\p{L}\p{N}._-]", "_")


def ascii_slug(col: Column) -> Column:
    """Runs of characters other than ASCII letters, digits, ``.``, ``_`` and ``-`` to one ``_``."""
    return F.regexp_replace(col, "[^A-Za-z0-9._-]+", "_")


def line_steps(content: Column) -> Column:
    """The texts of the lines ``N. text``, stripped."""
    lines = F.transform(F.split(content, "\n"), lambda x: F.regexp_replace(x, f"^{WS}+|{WS}+$", ""))
    return F.transform(F.filter(lines, lambda x: x.rlike(r"^\d+\.\s+")), lambda x: F.regexp_replace(x, r"^\d+\.\s+", ""))


def loose_steps(content: Column) -> Column:
    """As :func:`line_steps`, the space behind the number being optional and the text not empty."""
    lines = F.transform(F.split(content, "\n"), lambda x: F.regexp_extract(x, r"^\s*\d+\.\s*(.+?)\s*$", 1))
    return F.filter(lines, lambda x: x != "")


def shortcuts(content: Column) -> Column:
    """Bold spans that name a shortcut: collapsed, valid, distinct in order."""
    found = F.transform(F.regexp_extract_all(content, F.lit(r"\*\*([^*]+)\*\*"), F.lit(1)), lambda v: F.struct(collapse(v).alias("v"), clean_line(v).alias("c")))
    good = F.filter(found, lambda x: (x["c"] != "") & ~x["c"].endswith(":") & ~x["c"].rlike(NOTE_LABEL))
    return distinct_by_lower(F.transform(good, lambda x: x["v"]))


# Fixed value: what a word of the overlap measures is.
WORD = r"[A-Za-zÄÖÜäöüß0-9+\-]{3,}"


def words(text: Column, stopwords: list[str] | tuple[str, ...] = tuple(STOPWORDS)) -> Column:
    """The set of words of three characters or more, case-folded, without stop words."""
    folded = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.replace(F.lower(w), F.lit("ß"), F.lit("ss")))
    return F.array_except(F.array_distinct(folded), F.array(*(F.lit(w) for w in stopwords)))


def slug(text: Column) -> Column:
    """Lower case, umlauts spelt out, other runs to ``_``; never empty."""
    low = normalized_key(text)
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue")):
        low = F.replace(low, F.lit(a), F.lit(b))
    made = F.btrim(F.regexp_replace(low, "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(made == "", "section").otherwise(made)


def join_snippets(snippets: Column, max_chars: int = 340) -> Column:
    """Snippets joined while they fit; one that starts with the same eight words is left out, the first always stays."""
    head = lambda s: F.slice(F.split(F.trim(F.regexp_replace(F.replace(F.lower(s), F.lit("…"), F.lit("")), f"{WS}+", " ")), " "), 1, 8)

    def step(acc: Column, s: Column) -> Column:
        text, full = acc["text"], acc["full"]
        made = F.when(text == "", s).otherwise(F.concat(text, F.lit(" "), s))
        skip = full | ((text != "") & (head(text) == head(s)))
        over = F.length(made) > max_chars
        return F.struct(F.when(skip | over, text).otherwise(made).alias("text"), (full | (~skip & over)).alias("full"))

    done = F.aggregate(snippets, F.struct(F.lit("").alias("text"), F.lit(False).alias("full")), step)["text"]
    return F.when(done != "", done).otherwise(F.coalesce(F.get(snippets, F.lit(0)), F.lit("")))


# The patterns of chunk kinds, in their order.
KIND_WARNING = r"(?iuU)\b(?:Hinweis|Achtung|Warnung|Wichtig)\b"
KIND_FAQ = r"(?iuU)\bFAQ\b"
KIND_TABLE = r"(?iuU)\b(?:Tabelle|Spalte|Spalten)\b"
KIND_PROCEDURE = r"(?m)^\s*\d+\.\s+"
KIND_REFERENCE = r"^\s*(?:[-*+]\s+|\d+\.\s+)"


def chunk_type(title: Column, content: Column) -> Column:
    """The first kind that fits: warning, faq, table, procedure, reference, else concept."""
    tests = ((content.rlike(KIND_WARNING), "warning"), (title.rlike(KIND_FAQ), "faq"), (content.contains("|") & title.rlike(KIND_TABLE), "table"), (content.rlike(KIND_PROCEDURE), "procedure"), (content.rlike(KIND_REFERENCE), "reference"))
    return F.coalesce(*(F.when(test, kind) for test, kind in tests), F.lit("concept"))
