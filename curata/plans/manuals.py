"""Pages and documents to markdown, sections, chunks, drafts and jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.functions import text as tx
from curata.functions.hashing import hash_mod, stable_hash
from curata.operators import cards, html, sections
from curata.operators.drafts import drafts
from curata.operators.quota import hash_split, wave
from curata.plans.dialogs import word_sql
from curata.plans.metrics import HASH_SQL, KEY_SQL
from curata.plans.selection import TASKS as WAVE_ORDER
from curata.session import frozen, table


def line_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document: how many, how many blank, the longest."""
    rows = sections.line_rows(table(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(F.trim("line") == "").alias("n_blank"), F.max(F.length("line")).cast("long").alias("longest"))


def _with_headings(docs: DataFrame) -> DataFrame:
    """Documents whose lines of three words or fewer serve as headings."""
    mark = lambda line: F.when(F.trim(line).rlike(r"^\S+( \S+){0,2}$"), F.concat(F.lit("## "), F.trim(line))).otherwise(line)
    return docs.select("doc_id", "lang", "source", F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), mark), "\n").alias("text"))


def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of documents at every heading."""
    s = sections.simple_sections(_with_headings(table(spark, sf_dir, "documents")))
    return s.select("doc_id", "section_id", "title", F.length("content").cast("long").alias("n_chars"))


def greedy_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' lines packed into groups: number of groups and their sizes."""
    docs = table(spark, sf_dir, "documents")
    sizes = F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x) != ""), lambda x: F.length(x).cast("bigint"))
    packed = docs.select("doc_id", sections.pack_sizes(sizes).alias("g"))
    return packed.select("doc_id", F.size("g").cast("long").alias("n_groups"), F.array_join(F.transform("g", lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda a, v: a + v).cast("string")), ",").alias("sizes"))


def chunk_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the kind that the chunk rule gives them."""
    docs = table(spark, sf_dir, "documents")
    title = F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)  # the first line
    return docs.groupBy("lang", tx.chunk_type(title, F.coalesce("text", F.lit(""))).alias("kind")).agg(F.count("*").alias("n"))


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of each document: how many, and how many are leftovers of markup."""
    docs = table(spark, sf_dir, "documents").select("doc_id", tx.sentences(F.coalesce("text", F.lit(""))).alias("s"))
    return docs.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.size(F.filter("s", tx.is_artifact)).cast("long").alias("n_artifacts"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.chunks(_with_headings(table(spark, sf_dir, "documents")))


def hierarchical_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section-aware chunks with ids, spans, flags and counts."""
    return chunks(spark, sf_dir).select("chunk_id", "doc", "section_path_text", "source_span", "char_count", "chunk_type", "contains_list", "contains_steps", "chunk_index", "section_chunk_count", "chunk_count_in_doc", "summary")


def draft_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drafts of all chunks."""
    return drafts(chunks(spark, sf_dir)).drop("source_excerpt")


def teacher_jobs(spark: SparkSession, sf_dir: str, quota: int = 12) -> DataFrame:
    """A wave of jobs from drafts: hash split, then for each split and task a quota dealt over the documents in turns; a selected chunk is spent.

    Drafts are computed once; the wave reads their keys and scores only.
    """
    made = frozen(drafts(chunks(spark, sf_dir)).withColumn("split", hash_split(F.col("chunk_id"))))
    keys = made.select("split", F.col("task_type").alias("task"), "doc", F.col("chunk_id").alias("chunk"), "score", stable_hash(F.concat("chunk_id", F.lit("::"), "task_type")).alias("tie"), hash_mod(F.col("doc"), 1000).alias("turn"))
    picked, _ = wave(keys, {(s, t): quota for s in ("eval", "train") for t in WAVE_ORDER}, WAVE_ORDER)
    number = Window.partitionBy("split", "task").orderBy("place")  # at most a quota
    numbered = picked.select(F.format_string("wave::%s::%s::%04d", "split", "task", F.row_number().over(number)).alias("job_id"), F.col("split").alias("s"), F.col("task").alias("t"), F.col("chunk").alias("c"))
    joined = made.join(F.broadcast(numbered), (made["chunk_id"] == F.col("c")) & (made["task_type"] == F.col("t")))  # ten quotas of rows
    return joined.select("job_id", "split", "task_type", "doc", "chunk_id", "score", "user_message", "assistant_message", "selection_reason")


def html_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as markdown: title, length and checksum."""
    return html.normalize_pages(table(spark, sf_dir, "pages")).select("page_id", "title", F.length("markdown").cast("long").alias("n_chars"), "checksum")


def html_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of pages by pattern alone, which SQL can follow."""
    pages = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return pages.select("page_id", F.length(title).cast("long").alias("n_title"), F.sha2(title, 256).alias("title_hash"))


# The rules on a line and its neighbours, in the order in which they are checked: name and condition.
def line_rules():
    line, before, after = F.col("line"), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    heading, source = line.startswith("#"), line.startswith("Quelle:")
    follows = (after != "") & ~after.rlike(r"^(#|-|\*|>|```|\||\d\d)")
    return {
        "stray_quote": F.trim(line) == ">",
        "two_headings": heading & line.rlike(r"\s#{1,6}\s"),
        "heading_not_apart_before": heading & (before != ""),
        "heading_not_apart_after": heading & follows,
        "heading_with_prose": heading & (F.length(line) > 120) & line.rlike(r"[.!?]\s+\w+\s+\w+\s+\w+"),
        "heading_with_trailing_prose": line.rlike(r"^#{1,6}\s+.+?[.!?:][ \t]+\S"),
        "source_not_apart_before": source & (before != ""),
        "source_not_apart_after": source & (after != ""),
        "source_with_heading": line.rlike(r"Quelle:\s+#+\s") | (source & line.rlike(r"\s#{1,6}\s")),
        "heading_in_line": ~heading & line.rlike(r"\s#{1,6}\s"),
        "source_in_line": ~source & line.contains(" Quelle:"),
        "merged_items": line.rlike(r"^(?:- |\d+\.) .+ (?:- |\d+\.) ") | line.rlike(r"^\d+\..+\s\d+\.\s"),
        "item_with_source": line.rlike(r"^(?:- |\d+\.) .+ Quelle:"),
        "item_with_heading": line.rlike(r"^(?:- |\d+\.) .+\s#{1,6}\s"),
    }


def rule_violations(lines: DataFrame, key: str) -> DataFrame:
    """(``key``, ``pos``, ``rule``) of lines that break a rule of markdown structure."""
    w = Window.partitionBy(key).orderBy("pos")
    near = lines.withColumns({"before": F.lag("line").over(w), "after": F.lead("line").over(w)})
    found = F.array_compact(F.array(*(F.when(cond, name) for name, cond in line_rules().items())))
    return near.select(key, "pos", F.explode(found).alias("rule"))


def marked_up(docs: DataFrame) -> DataFrame:
    """Documents with marks that lines of markdown have: by id, place and length a heading, an item, a source or a quote."""
    def mark(line, i):
        n = F.pmod(F.col("doc_id") * 7 + i * 5 + F.length(line), F.lit(11))
        return (
            F.when(n == 0, F.concat(F.lit("## "), line)).when(n == 1, F.concat(F.lit("- one - two "), line)).when(n == 2, F.concat(F.lit("Quelle: "), line)).when(n == 3, F.lit(" > "))
            .when(n == 4, F.concat(F.lit("text ## "), line)).when(n == 5, F.concat(line, F.lit(" Quelle: here"))).when(n == 6, F.lit("")).when(n == 7, F.concat(F.lit("1. a 2. "), line, F.lit(" # x"))).otherwise(line)
        )

    return docs.select("doc_id", F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), mark), "\n").alias("text"))


def markdown_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations in marked-up documents, by rule."""
    lines = sections.line_rows(marked_up(table(spark, sf_dir, "documents")), "doc_id", "text")
    return rule_violations(lines, "doc_id").groupBy("rule").agg(F.count("*").alias("n"))


def page_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations in the markdown of pages, by rule."""
    md = html.normalize_pages(table(spark, sf_dir, "pages"))
    return rule_violations(sections.line_rows(md, "page_id", "markdown"), "page_id").groupBy("rule").agg(F.count("*").alias("n"))


def chunk_faults(c: DataFrame, least: int = sections.MIN_MEANINGFUL) -> DataFrame:
    """(``chunk_id``, ``reason``): chunks that break integrity: gaps in the index, wrong counts or lengths, spans out of order, a foreign document in the id."""
    by = Window.partitionBy("doc")
    checks = F.array_compact(
        F.array(
            F.when(F.col("chunk_index") != F.row_number().over(by.orderBy("chunk_index", "chunk_id")), "index not contiguous"),
            F.when(F.col("chunk_count_in_doc") != F.count("*").over(by), "wrong count"),
            F.when(F.col("char_count") != F.length("content"), "wrong length"),
            F.when(F.col("char_count") < least, "too short"),
            F.when(F.col("line_start") > F.col("line_end"), "span out of order"),
            F.when(~F.col("chunk_id").startswith(F.concat("doc", F.lit("::"))), "foreign id"),
        )
    )
    return c.select("chunk_id", checks.alias("r")).select("chunk_id", F.explode("r").alias("reason"))


def chunk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of the chunks that are made: none are expected."""
    return chunk_faults(chunks(spark, sf_dir))


def spoiled_chunk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of documents taken as chunks of their source, some spoiled by hash: by reason."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    h = lambda tag, n: hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit(f"::{tag}")), n) == 0
    by = Window.partitionBy("source")
    place = F.row_number().over(by.orderBy("doc_id"))
    c = docs.select(
        F.concat(F.when(h("foreign", 41), "other").otherwise(F.col("source")), F.lit("::"), F.col("doc_id").cast("string")).alias("chunk_id"), F.col("source").alias("doc"), F.col("text").alias("content"),
        (place + F.when(h("gap", 37), 1).otherwise(0)).alias("chunk_index"), (F.count("*").over(by) + F.when(h("count", 43), 1).otherwise(0)).alias("chunk_count_in_doc"),
        (F.length("text") + F.when(h("length", 29), 1).otherwise(0)).alias("char_count"), F.when(h("span", 31), 9).otherwise(1).alias("line_start"), F.lit(5).alias("line_end"),
    )
    return chunk_faults(c).groupBy("reason").agg(F.count("*").alias("n"))


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar text functions over documents."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", tx.preview(t, 60).alias("preview"), tx.summary(t, 40).alias("summary"), F.sha2(tx.slug(t), 256).alias("slug_hash"), F.sha2(tx.safe_slug(tx.preview(t, 60)), 256).alias("safe_slug_hash"), F.sha2(tx.ascii_slug(t), 256).alias("ascii_slug_hash"), F.sha2(tx.compact_text(t), 256).alias("compact_hash"), F.size(tx.line_steps(t)).cast("long").alias("n_steps"), F.size(tx.loose_steps(t)).cast("long").alias("n_loose_steps"), F.size(tx.words(t)).cast("long").alias("n_words"), F.sha2(tx.normalized_key(t), 256).alias("key_hash"))


def simple_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk for each section of a document."""
    c = cards.simple_chunks(sections.simple_sections(_with_headings(table(spark, sf_dir, "documents"))), "doc_id")
    return c.select("chunk_id", "doc_id", "section_id", "title", F.length("content").cast("long").alias("n_chars"), F.sha2("summary", 256).alias("summary_hash"))


def task_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card for each simple chunk."""
    c = cards.simple_chunks(sections.simple_sections(_with_headings(table(spark, sf_dir, "documents"))), "doc_id")
    made = cards.task_cards(c)
    return made.select("task_card_id", "task_type", "review_status", F.element_at("source_chunk_ids", 1).alias("chunk_id"), F.sha2("user_goal", 256).alias("goal_hash"))


def card_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chat sample for each card; where a card names no chunks, its own id takes their place."""
    labels = table(spark, sf_dir, "labels")
    ids = F.when(F.col("quality") == 1, F.array(F.concat(F.lit("chunk_"), F.col("doc_id").cast("string"))))
    made = cards.samples(labels.select(F.concat(F.lit("card_"), F.col("doc_id").cast("string")).alias("task_card_id"), F.lit("faq").alias("task_type"), F.concat(F.lit("goal "), F.col("doc_id").cast("string")).alias("user_goal"), ids.alias("source_chunk_ids")), "system")
    return made.select("id", F.size("messages").cast("long").alias("n_messages"), F.array_join("messages.role", ",").alias("roles"), F.array_join("source_chunk_ids", ",").alias("chunks"), F.element_at("messages", 2)["content"].alias("asks"))


def recipe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For recipes that name a document and a section the first chunk that fits: here every tenth section, as if chosen by hand."""
    c = cards.simple_chunks(sections.simple_sections(_with_headings(table(spark, sf_dir, "documents"))), "doc_id")
    c = c.select(F.col("doc_id").alias("doc"), F.col("title").alias("section_title"), "chunk_id", F.lit(1).alias("chunk_index_in_section"))
    chosen = c.where(hash_mod(F.col("chunk_id"), 10) == 0).select(F.concat(F.lit("recipe_"), "chunk_id").alias("recipe_id"), "doc", "section_title", F.when(hash_mod(F.col("chunk_id"), 20) == 0, 1).alias("index"))
    return cards.recipe_matches(chosen, c, "chunk_id")


QUERIES = {
    f.__name__: f
    for f in (line_explode, section_split, greedy_pack, chunk_types, sentence_split, hierarchical_chunks, draft_cases, teacher_jobs, html_normalize, html_titles, markdown_line_rules, page_line_rules, chunk_violations, spoiled_chunk_violations, simple_chunks, task_cards, card_samples, recipe_chunks, text_functions)
}

_COLLAPSED = "trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'))"
_LINES = "l AS (SELECT doc_id, generate_subscripts(s, 1) AS pos, unnest(s) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))"
_WS = "[ \\t\\n\\r\\f\\x0B]"
_SQUEEZE = lambda x: f"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"
_PLAIN = lambda x: _SQUEEZE(f"replace(replace(replace(regexp_replace({x}, '\\[([^\\]]+)\\]\\(([^)]+)\\)', '\\1', 'g'), '**', ''), chr(96), ''), '_', ' ')")
_CLEAN = lambda x: f"trim(trim({_SQUEEZE(f"regexp_replace({_PLAIN(x)}, '^\\d+\\.\\s*', '')")}, '- '))"
_HH = lambda tag, n: f"({HASH_SQL.format(f"doc_id::VARCHAR || '::{tag}'")} % {n} = 0)"
_SIMPLE = f"""WITH {_LINES},
        m AS (SELECT doc_id, pos, CASE WHEN regexp_matches(trim(line), '^\\S+( \\S+){{0,2}}$') THEN '## ' || trim(line) ELSE line END AS line FROM l),
        h AS (SELECT *, regexp_matches(line, '^(#{{1,6}})\\s+(.*)$') AS is_h FROM m),
        n AS (SELECT *, sum(is_h::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS sec FROM h),
        s AS (SELECT doc_id, sec, format('sec_{{:04d}}', sec::INT) AS section_id, coalesce(max(CASE WHEN is_h THEN regexp_extract(line, '^(#{{1,6}})\\s+(.*)$', 2) END), 'Document Start') AS title, string_agg(line, chr(10) ORDER BY pos) AS content FROM n GROUP BY doc_id, sec),
        k AS (SELECT *, doc_id || '::' || format('chunk_{{:04d}}', (row_number() OVER (PARTITION BY doc_id ORDER BY sec) - 1)::INT) AS chunk_id FROM s)"""
_M = lambda p: f"regexp_matches(line, '{p}')"
_RULES_SQL = {
    "stray_quote": "trim(line) = '>'",
    "two_headings": "hd AND " + _M("\\s#{1,6}\\s"),
    "heading_not_apart_before": "hd AND b <> ''",
    "heading_not_apart_after": "hd AND a <> '' AND NOT regexp_matches(a, '^(#|-|\\*|>|```|\\||\\d\\d)')",
    "heading_with_prose": "hd AND length(line) > 120 AND " + _M("[.!?]\\s+\\w+\\s+\\w+\\s+\\w+"),
    "heading_with_trailing_prose": _M("^#{1,6}\\s+.+?[.!?:][ \\t]+\\S"),
    "source_not_apart_before": "src AND b <> ''",
    "source_not_apart_after": "src AND a <> ''",
    "source_with_heading": _M("Quelle:\\s+#+\\s") + " OR (src AND " + _M("\\s#{1,6}\\s") + ")",
    "heading_in_line": "NOT hd AND " + _M("\\s#{1,6}\\s"),
    "source_in_line": "NOT src AND contains(line, ' Quelle:')",
    "merged_items": _M("^(?:- |\\d+\\.) .+ (?:- |\\d+\\.) ") + " OR " + _M("^\\d+\\..+\\s\\d+\\.\\s"),
    "item_with_source": _M("^(?:- |\\d+\\.) .+ Quelle:"),
    "item_with_heading": _M("^(?:- |\\d+\\.) .+\\s#{1,6}\\s"),
}
ORACLES = {
    "line_explode": f"WITH {_LINES} SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE trim(line) = '') AS n_blank, max(length(line)) AS longest FROM l GROUP BY doc_id",
    "section_split": f"""WITH {_LINES},
        m AS (SELECT doc_id, pos, CASE WHEN regexp_matches(trim(line), '^\\S+( \\S+){{0,2}}$') THEN '## ' || trim(line) ELSE line END AS line FROM l),
        h AS (SELECT *, regexp_matches(line, '^(#{{1,6}})\\s+(.*)$') AS is_h FROM m),
        n AS (SELECT *, sum(is_h::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS sec FROM h)
        SELECT doc_id, format('sec_{{:04d}}', sec::INT) AS section_id, coalesce(max(CASE WHEN is_h THEN regexp_extract(line, '^(#{{1,6}})\\s+(.*)$', 2) END), 'Document Start') AS title,
               (sum(length(line) + 1) - 1)::BIGINT AS n_chars FROM n GROUP BY doc_id, sec""",
    "chunk_types": """SELECT lang, CASE WHEN regexp_matches(t, '(?i)\\b(?:Hinweis|Achtung|Warnung|Wichtig)\\b') THEN 'warning' WHEN regexp_matches(split_part(t, chr(10), 1), '(?i)\\bFAQ\\b') THEN 'faq'
        WHEN contains(t, '|') AND regexp_matches(split_part(t, chr(10), 1), '(?i)\\b(?:Tabelle|Spalte|Spalten)\\b') THEN 'table' WHEN regexp_matches(t, '(?m)^\\s*\\d+\\.\\s+') THEN 'procedure'
        WHEN regexp_matches(t, '^\\s*(?:[-*+]\\s+|\\d+\\.\\s+)') THEN 'reference' ELSE 'concept' END AS kind, count(*) AS n FROM (SELECT lang, coalesce(text, '') AS t FROM documents) GROUP BY ALL""",
    "html_titles": "SELECT page_id, length(t) AS n_title, sha256(t) AS title_hash FROM (SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS t FROM pages)",
    "greedy_pack": f"""WITH RECURSIVE {_LINES},
        u AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i, length(line)::BIGINT AS n FROM l WHERE trim(line) <> ''),
        p AS (SELECT doc_id, i, n, 0::BIGINT AS g, n AS size FROM u WHERE i = 1
              UNION ALL SELECT doc_id, i, n, g + shut::BIGINT, CASE WHEN shut THEN 0 ELSE size END + 2 + n
              FROM (SELECT u.doc_id, u.i, u.n, p.g, p.size, (p.size + 2 + u.n > 2200 AND (p.size >= 450 OR u.n >= 1500 OR p.size >= 225)) OR (p.size >= 1500 AND u.n > 550) AS shut FROM p JOIN u ON u.doc_id = p.doc_id AND u.i = p.i + 1)),
        s AS (SELECT doc_id, g, sum(n)::BIGINT AS n FROM p GROUP BY ALL)
        SELECT d.doc_id, coalesce(x.k, 0) AS n_groups, coalesce(x.sizes, '') AS sizes FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS k, string_agg(n::VARCHAR, ',' ORDER BY g) AS sizes FROM s GROUP BY doc_id) x ON d.doc_id = x.doc_id""",
    "sentence_split": f"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g'), '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)), lambda x: {_CLEAN('x')}),
            lambda x: x <> '' AND x NOT IN ('1.', '2.', '3.', '4.', '5.')) AS s FROM documents)
        SELECT doc_id, len(s) AS n_sentences, len(list_filter(list_transform(s, lambda x: {_CLEAN('x')}), lambda c: c = '' OR regexp_matches(c, '…|â€¦|\\.\\.\\.') OR regexp_matches(c, '\\|\\s*---|\\|\\s*Beschreibung\\s*\\|') OR starts_with(c, '|')
            OR starts_with(lower(c), 'hinweis:') OR starts_with(lower(c), 'achtung:') OR starts_with(lower(c), 'wichtig:'))) AS n_artifacts FROM s""",
    "text_functions": f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, {_COLLAPSED} AS c, {KEY_SQL.format('text')} AS k FROM documents),
        p AS (SELECT *, CASE WHEN length(c) <= 60 THEN c ELSE substr(c, 1, 57) || '...' END AS preview, trim(regexp_replace(replace(replace(replace(k, 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
              list_transform(string_split(replace(t, chr(13) || chr(10), chr(10)), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12))) AS lines FROM t)
        SELECT doc_id, preview, CASE WHEN length(c) <= 40 THEN c ELSE rtrim(substr(c, 1, 39)) || '…' END AS summary, sha256(CASE WHEN slug = '' THEN 'section' ELSE slug END) AS slug_hash,
          sha256(regexp_replace(preview, '[^\\p{{L}}\\p{{N}}._-]', '_', 'g')) AS safe_slug_hash, sha256(regexp_replace(t, '[^A-Za-z0-9._-]+', '_', 'g')) AS ascii_slug_hash,
          sha256(trim(regexp_replace(array_to_string(lines, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'), chr(10))) AS compact_hash, len(list_filter(lines, lambda x: regexp_matches(x, '^\\d+\\.\\s+'))) AS n_steps,
          len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*\\d+\\.\\s*(.+?)\\s*$'))) AS n_loose_steps, len({word_sql('t')}) AS n_words, sha256(k) AS key_hash FROM p""",
    "markdown_line_rules": f"""WITH {_LINES}, h AS (SELECT doc_id, pos, (doc_id * 7 + (pos - 1) * 5 + length(line)) % 11 AS n, line FROM l),
        m AS (SELECT doc_id, pos, CASE n WHEN 0 THEN '## ' || line WHEN 1 THEN '- one - two ' || line WHEN 2 THEN 'Quelle: ' || line WHEN 3 THEN ' > ' WHEN 4 THEN 'text ## ' || line WHEN 5 THEN line || ' Quelle: here'
              WHEN 6 THEN '' WHEN 7 THEN '1. a 2. ' || line || ' # x' ELSE line END AS line FROM h),
        w AS (SELECT *, coalesce(lag(line) OVER (PARTITION BY doc_id ORDER BY pos), '') AS b, coalesce(lead(line) OVER (PARTITION BY doc_id ORDER BY pos), '') AS a, starts_with(line, '#') AS hd, starts_with(line, 'Quelle:') AS src FROM m),
        r AS (SELECT unnest([{", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in _RULES_SQL.items())}]) AS rule FROM w)
        SELECT rule, count(*) AS n FROM r WHERE rule IS NOT NULL GROUP BY rule""",
    "spoiled_chunk_violations": f"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place, count(*) OVER (PARTITION BY source) AS total FROM documents WHERE text IS NOT NULL),
        c AS (SELECT *, CASE WHEN {_HH('foreign', 41)} THEN 'other' ELSE source END || '::' || doc_id AS chunk_id, place + {_HH('gap', 37)}::INT AS idx FROM d),
        f AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY idx, chunk_id) AS want FROM c),
        r AS (SELECT unnest([CASE WHEN idx <> want THEN 'index not contiguous' END, CASE WHEN {_HH('count', 43)} THEN 'wrong count' END, CASE WHEN {_HH('length', 29)} THEN 'wrong length' END,
          CASE WHEN length(text) + {_HH('length', 29)}::INT < {sections.MIN_MEANINGFUL} THEN 'too short' END, CASE WHEN {_HH('span', 31)} THEN 'span out of order' END, CASE WHEN NOT starts_with(chunk_id, source || '::') THEN 'foreign id' END]) AS reason FROM f)
        SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""",
    "simple_chunks": f"{_SIMPLE} SELECT chunk_id, doc_id, section_id, title, length(content)::BIGINT AS n_chars, sha256(replace(substr(content, 1, 180), chr(10), ' ')) AS summary_hash FROM k",
    "task_cards": f"{_SIMPLE} SELECT 'card_' || chunk_id AS task_card_id, 'faq' AS task_type, 'draft' AS review_status, chunk_id, sha256('Explain: ' || title) AS goal_hash FROM k",
    "recipe_chunks": f"""{_SIMPLE}, r AS (SELECT 'recipe_' || chunk_id AS recipe_id, doc_id, title FROM k WHERE {HASH_SQL.format('chunk_id')} % 10 = 0)
        SELECT recipe_id, min(k.chunk_id) AS chunk_id FROM r JOIN k ON k.doc_id = r.doc_id AND k.title = r.title GROUP BY recipe_id""",
    "card_samples": """SELECT 'sft_card_' || doc_id AS id, 3 AS n_messages, 'system,user,assistant' AS roles, CASE WHEN quality = 1 THEN 'chunk_' || doc_id ELSE 'card_' || doc_id END AS chunks, 'goal ' || doc_id AS asks FROM labels""",
}
