"""Chat records, evaluation cases, checks and lexical overlap over ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions.text import STOPWORDS, normalized_key, words
from curata.plans.metrics import CONV_SQL, KEY_SQL, first_and_last
from curata.session import table


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each conversation with its messages in turn order."""
    conv = table(spark, sf_dir, "conversations")
    grouped = conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    return grouped.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), F.coalesce(x["text"], F.lit("")).alias("content"))).alias("messages"), F.col("m.turn").alias("turns"))


def chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export records: conversations that end in an answer that isn't blank."""
    m = messages(spark, sf_dir)
    last = F.element_at("messages", -1)
    good = m.where((F.size("messages") >= 2) & (last["role"] == "assistant") & (F.trim(last["content"]) != ""))
    return good.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_messages"),
        F.array_join("messages.role", ",").alias("roles"),
        F.sha2(F.array_join(F.transform("messages", lambda x: F.concat_ws(":", x["role"], x["content"])), "\n"), 256).alias("digest"),
    )


def eval_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation cases from chats: the last user text as prompt, the last answer as reference."""
    conv = table(spark, sf_dir, "conversations")
    pick = lambda role: F.max_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    return conv.groupBy("conv_id").agg(pick("user").alias("prompt"), pick("assistant").alias("reference_answer")).where("prompt is not null and reference_answer is not null").withColumn("eval_id", F.concat(F.lit("eval::"), F.col("conv_id").cast("string")))


def chat_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a constraint of chat records, a reason each."""
    m = messages(spark, sf_dir)
    last = F.element_at("messages", -1)
    reasons = F.array(
        F.when(F.size("messages") < 2, "fewer than two messages"),
        F.when(last["role"] != "assistant", "last message isn't the assistant's"),
        F.when(F.exists("messages", lambda x: F.trim(x["content"]) == ""), "blank message"),
        F.when(~F.exists("messages", lambda x: x["role"] == "user"), "no user message"),
        F.when(F.size(F.array_distinct("turns")) < F.size("turns"), "repeated turn"),
    )
    return m.select("conv_id", F.explode(F.array_compact(reasons)).alias("reason"))


def overlap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = first_and_last(spark, sf_dir).where("answer is not null")
    sets = c.select("conv_id", "answer", words(F.coalesce("answer", F.lit(""))).alias("a"), words(F.coalesce("prompt", F.lit(""))).alias("s"))
    size = F.greatest(F.size("a"), F.lit(1))
    return sets.select("conv_id", "answer", F.size("a").cast("long").alias("n_words"), (F.size(F.array_intersect("a", "s")) / size).alias("overlap"), (F.size(F.array_except("a", "s")) / size).alias("novel"))


def lexical_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of an answer's words that its prompt has, and that it has not."""
    return overlap_rows(spark, sf_dir).select("conv_id", "n_words", F.round("overlap", 4).alias("overlap_ratio"), F.round("novel", 4).alias("novel_ratio"))


def overlap_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of the audit's flags."""
    r = overlap_rows(spark, sf_dir)
    flags = F.array(
        F.when(F.col("overlap") < 0.2, "low_lexical_overlap"),
        F.when(F.col("novel") > 0.75, "high_novel_word_ratio"),
        F.when(F.col("answer").rlike(r"(\.\.\.|…)$"), "assistant_ends_with_ellipsis"),
    )
    return r.select(F.explode(F.array_compact(flags)).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def benchmark_line_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that documents share with benchmark items, by item; lines are compared by key."""
    lines = lambda df, i: df.select(i, F.explode(F.split("text", "\n")).alias("line")).select(i, normalized_key(F.col("line")).alias("key")).where(F.length("key") >= 20)
    # the benchmark's lines are few: the optimizer broadcasts them if their size allows, and only hits are grouped
    docs, bench = lines(table(spark, sf_dir, "documents"), "doc_id"), lines(table(spark, sf_dir, "benchmark"), "item_id").distinct()
    return docs.join(bench, "key").groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.countDistinct("key").alias("n_lines"))


_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_WORDS = "list_filter(list_distinct(list_transform(regexp_extract_all(coalesce({0}, ''), '[A-Za-zÄÖÜäöüß0-9+\\-]{{3,}}'), lambda w: replace(lower(w), 'ß', 'ss'))), lambda w: w NOT IN (" + _STOP + "))"


def word_sql(column: str) -> str:
    """The set of words of a text, in SQL."""
    return _WORDS.format(column)


_OVERLAP = f"""{CONV_SQL},
w AS (SELECT conv_id, answer, {_WORDS.format('answer')} AS a, {_WORDS.format('prompt')} AS s FROM c WHERE answer IS NOT NULL),
r AS (SELECT conv_id, answer, len(a) AS n_words, len(list_intersect(a, s)) / greatest(len(a), 1) AS overlap, (len(a) - len(list_intersect(a, s))) / greatest(len(a), 1) AS novel FROM w)"""
_MESSAGES = "m AS (SELECT conv_id, list({'role': role, 'content': coalesce(text, '')} ORDER BY turn, role, text) AS m, list(turn) AS turns FROM conversations GROUP BY conv_id)"

QUERIES = {f.__name__: f for f in (chat_records, eval_cases, chat_violations, lexical_overlap, overlap_flags, benchmark_line_overlap)}
ORACLES = {
    "chat_records": f"""WITH {_MESSAGES} SELECT conv_id, len(m) AS n_messages, array_to_string(list_transform(m, lambda x: x.role), ',') AS roles,
        sha256(array_to_string(list_transform(m, lambda x: x.role || ':' || x.content), chr(10))) AS digest
        FROM m WHERE len(m) >= 2 AND m[-1].role = 'assistant' AND trim(m[-1].content) <> ''""",
    "eval_cases": """SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'user') AS prompt, arg_max(text, turn) FILTER (WHERE role = 'assistant') AS reference_answer, 'eval::' || conv_id AS eval_id
        FROM conversations GROUP BY conv_id HAVING prompt IS NOT NULL AND reference_answer IS NOT NULL""",
    "chat_violations": f"""WITH {_MESSAGES}, f AS (SELECT conv_id, [
          CASE WHEN len(m) < 2 THEN 'fewer than two messages' END,
          CASE WHEN m[-1].role <> 'assistant' THEN 'last message isn''t the assistant''s' END,
          CASE WHEN len(list_filter(m, lambda x: trim(x.content) = '')) > 0 THEN 'blank message' END,
          CASE WHEN len(list_filter(m, lambda x: x.role = 'user')) = 0 THEN 'no user message' END,
          CASE WHEN len(list_distinct(turns)) < len(turns) THEN 'repeated turn' END] AS r FROM m)
        SELECT conv_id, reason FROM (SELECT conv_id, unnest(r) AS reason FROM f) WHERE reason IS NOT NULL""",
    "lexical_overlap": f"WITH {_OVERLAP} SELECT conv_id, n_words, round(overlap, 4) AS overlap_ratio, round(novel, 4) AS novel_ratio FROM r",
    "overlap_flags": f"""WITH {_OVERLAP}, f AS (SELECT unnest([CASE WHEN overlap < 0.2 THEN 'low_lexical_overlap' END, CASE WHEN novel > 0.75 THEN 'high_novel_word_ratio' END,
        CASE WHEN regexp_matches(answer, '(\\.\\.\\.|…)$') THEN 'assistant_ends_with_ellipsis' END]) AS flag FROM r)
        SELECT flag, count(*) AS n FROM f WHERE flag IS NOT NULL GROUP BY flag""",
    "benchmark_line_overlap": f"""WITH d AS (SELECT DISTINCT doc_id, {KEY_SQL.format('line')} AS key FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
        b AS (SELECT DISTINCT item_id, {KEY_SQL.format('line')} AS key FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark))
        SELECT item_id, count(DISTINCT doc_id) AS n_docs, count(DISTINCT key) AS n_lines FROM d JOIN b USING (key) WHERE length(key) >= 20 GROUP BY item_id""",
}
