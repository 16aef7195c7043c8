"""Dataset metrics: duplicates, lengths, histograms, pivots, digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.functions.hashing import hash_mod, stable_hash
from curata.functions.text import normalized_key, preview
from curata.session import table

KEY_SQL = "replace(lower(trim(regexp_replace(coalesce({0}, ''), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'))), 'ß', 'ss')"
HASH_SQL = "concat('0x', substr(sha256({0}), 1, 16))::UBIGINT"


def dup_excess_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct texts and the excess of duplicates of each language; one row a text crosses the network."""
    docs = table(spark, sf_dir, "documents")
    keys = docs.groupBy("lang", F.sha2(normalized_key(F.col("text")), 256).alias("key")).agg(F.count("*").alias("n"))
    return keys.groupBy("lang").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct"), (F.sum("n") - F.count("*")).alias("excess"))


def first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's first user text and last assistant text."""
    conv = table(spark, sf_dir, "conversations")
    return conv.groupBy("conv_id").agg(
        F.min_by(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "user", F.col("turn"))).alias("prompt"),
        F.max_by(F.when(F.col("role") == "assistant", F.col("text")), F.when(F.col("role") == "assistant", F.col("turn"))).alias("answer"),
    )


CONV_SQL = """
c AS (SELECT conv_id,
             arg_min(text, turn) FILTER (WHERE role = 'user') AS prompt,
             arg_max(text, turn) FILTER (WHERE role = 'assistant') AS answer
      FROM conversations GROUP BY conv_id)"""


def repeated_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User messages that occur several times, compared whole: the 20 most repeated, with the roles' answers and the first ten places."""
    conv = table(spark, sf_dir, "conversations")
    after = Window.partitionBy("conv_id").orderBy("turn")
    c = conv.withColumn("answer", F.lead("text").over(after)).where("role = 'user'").select(F.format_string("%d/%d", "conv_id", "turn").alias("id"), F.struct("conv_id", "turn").alias("at"), normalized_key(F.col("text")).alias("key"), F.sha2(normalized_key(F.col("answer")), 256).alias("a"))
    # a frequent prompt keeps its ten first places, whatever their number
    ranked = c.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("at")))
    firsts = ranked.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("a").alias("n_answers"), F.array_sort(F.collect_list(F.when(F.col("_n") <= 10, F.struct("at", "id")))).alias("ids")).where("n > 1")
    return firsts.orderBy(F.desc("n"), "key").limit(20).select(F.sha2("key", 256).alias("prompt_hash"), preview(F.col("key"), 180).alias("prompt"), "n", "n_answers", F.array_join("ids.id", ",").alias("first_ids"))


def duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of text and source that several documents share, compared whole, with the excess of each language."""
    pairs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2(F.concat_ws("\u0001", normalized_key(F.col("source")), normalized_key(F.col("text"))), 256).alias("pair"))
    return pairs.groupBy("pair").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.countDistinct("lang").alias("n_langs")).where("n > 1")


def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, nearest-rank percentiles and maximum of the text lengths of each language."""
    rank = lambda p: F.expr(f"cast(percentile_disc({p}) WITHIN GROUP (ORDER BY n) AS bigint)")
    sized = table(spark, sf_dir, "documents").select("lang", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
    return sized.groupBy("lang").agg(F.count("*").alias("n_rows"), F.median("n").alias("median_len"), rank(0.95).alias("p95_len"), rank(0.99).alias("p99_len"), F.max("n").alias("max_len"))


def top_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve most frequent beginnings of answers; ties in order of first appearance."""
    conv = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    p = conv.select(F.substring(normalized_key(F.col("text")), 1, 64).alias("prefix"), F.struct("conv_id", "turn").alias("at"))
    g = p.groupBy("prefix").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    return g.orderBy(F.desc("n"), "at", "prefix").limit(12).select("prefix", "n")


def decision_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved and rejected documents of each source, zero-filled."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    j = docs.select("doc_id", "source").join(labels, "doc_id").withColumn("decision", F.when(F.col("quality") == 1, "approve").otherwise("reject"))
    return j.groupBy("source").pivot("decision", ["approve", "reject"]).count().na.fill(0)


def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores in bands, with least, median and greatest, for each decision."""
    s = table(spark, sf_dir, "labels").select("quality", hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit("::score")), 101).alias("s"))
    band = lambda lo, hi: F.count_if((F.col("s") >= lo) & (F.col("s") < hi))
    return s.groupBy(F.col("quality").cast("int").alias("quality")).agg(
        band(0, 60).alias("below_60"), band(60, 70).alias("b60_69"), band(70, 80).alias("b70_79"), band(80, 90).alias("b80_89"), band(90, 1000).alias("b90_up"),
        F.min("s").alias("least"), F.median("s").alias("median"), F.max("s").alias("greatest"),
    )


def attempt_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows needed how many attempts; a missing or zero number counts as one."""
    a = table(spark, sf_dir, "labels").select(F.nullif(hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit("::attempt")), 4), F.lit(0)).alias("a"))
    return a.groupBy(F.coalesce("a", F.lit(1)).cast("long").alias("attempts")).agg(F.count("*").alias("n"))


def argmax_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best approved and the worst rejected document of each source."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    j = docs.select("doc_id", "source").join(labels, "doc_id").withColumn("s", hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit("::score")), 101))
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    return j.groupBy("source").agg(F.max_by(F.when(good, F.col("doc_id")), F.when(good, F.struct("s", "doc_id"))).alias("best_approved"), F.min_by(F.when(bad, F.col("doc_id")), F.when(bad, F.struct("s", "doc_id"))).alias("worst_rejected"))


def doc_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations and messages of each role, from message arrays taken apart."""
    conv = table(spark, sf_dir, "conversations")
    roles = conv.groupBy("conv_id").agg(F.collect_list("role").alias("roles"))
    return roles.select("conv_id", F.explode("roles").alias("role")).groupBy("role").agg(F.count("*").alias("n_messages"), F.countDistinct("conv_id").alias("n_conversations"))


def manifest_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each source's rows that no order or partitioning changes: the sum of row hashes, with counts and sizes."""
    docs = table(spark, sf_dir, "documents")
    row = stable_hash(F.concat_ws("\u0001", F.col("doc_id").cast("string"), F.sha2(F.coalesce("text", F.lit("")), 256)))
    return docs.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum(F.octet_length(F.coalesce("text", F.lit("")))).cast("long").alias("n_bytes"), F.sum(row).cast("string").alias("digest"))


def source_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selection report: rows and characters by language and source, with subtotals."""
    docs = table(spark, sf_dir, "documents")
    return docs.rollup("lang", "source").agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars"), F.grouping_id().cast("long").alias("level"))


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset report: the first two documents of each language and source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy("doc_id"))).where("rank <= 2").withColumn("rank", F.col("rank").cast("long"))


QUERIES = {
    f.__name__: f
    for f in (dup_excess_by_lang, repeated_prompts, duplicate_pairs, length_stats, top_prefixes, decision_pivot, score_bands, attempt_hist, argmax_examples, doc_distribution, manifest_digest, source_rollup, stratified_sample)
}

ORACLES = {
    "dup_excess_by_lang": f"SELECT lang, count(*) AS n_rows, count(DISTINCT {KEY_SQL.format('text')}) AS n_distinct, count(*) - count(DISTINCT {KEY_SQL.format('text')}) AS excess FROM documents GROUP BY lang",
    "repeated_prompts": f"""WITH t AS (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations),
        k AS (SELECT conv_id, turn, {KEY_SQL.format('text')} AS key, {KEY_SQL.format('answer')} AS a FROM t WHERE role = 'user'),
        g AS (SELECT key, count(*) AS n, count(DISTINCT a) AS n_answers, list(conv_id || '/' || turn ORDER BY conv_id, turn)[1:10] AS ids FROM k GROUP BY key HAVING count(*) > 1)
        SELECT sha256(key) AS prompt_hash, CASE WHEN length(key) <= 180 THEN key ELSE substr(key, 1, 177) || '...' END AS prompt, n, n_answers, array_to_string(ids, ',') AS first_ids
        FROM g ORDER BY n DESC, key LIMIT 20""",
    "duplicate_pairs": f"""SELECT sha256({KEY_SQL.format('source')} || chr(1) || {KEY_SQL.format('text')}) AS pair, count(*) AS n, min(doc_id) AS first_doc, max(doc_id) AS last_doc, count(DISTINCT lang) AS n_langs
        FROM documents GROUP BY 1 HAVING count(*) > 1""",
    "length_stats": """SELECT lang, count(*) AS n_rows, median(n) AS median_len, quantile_disc(n, 0.95) AS p95_len, quantile_disc(n, 0.99) AS p99_len, max(n) AS max_len
        FROM (SELECT lang, length(coalesce(text, '')) AS n FROM documents) GROUP BY lang""",
    "top_prefixes": f"""SELECT prefix, n FROM (SELECT substr({KEY_SQL.format('text')}, 1, 64) AS prefix, count(*) AS n, min((conv_id, turn)) AS seen
        FROM conversations WHERE role = 'assistant' GROUP BY 1) ORDER BY n DESC, seen, prefix LIMIT 12""",
    "decision_pivot": """SELECT source, count(*) FILTER (WHERE quality = 1) AS approve, count(*) FILTER (WHERE quality <> 1 OR quality IS NULL) AS reject
        FROM documents JOIN labels USING (doc_id) GROUP BY source""",
    "score_bands": f"""WITH s AS (SELECT quality::INT AS quality, ({HASH_SQL.format("doc_id::VARCHAR || '::score'")} % 101)::BIGINT AS s FROM labels)
        SELECT quality, count(*) FILTER (WHERE s < 60) AS below_60, count(*) FILTER (WHERE s BETWEEN 60 AND 69) AS b60_69, count(*) FILTER (WHERE s BETWEEN 70 AND 79) AS b70_79,
               count(*) FILTER (WHERE s BETWEEN 80 AND 89) AS b80_89, count(*) FILTER (WHERE s >= 90) AS b90_up, min(s) AS least, median(s) AS median, max(s) AS greatest
        FROM s GROUP BY quality""",
    "attempt_hist": f"""SELECT CASE WHEN a = 0 THEN 1 ELSE a END AS attempts, count(*) AS n
        FROM (SELECT ({HASH_SQL.format("doc_id::VARCHAR || '::attempt'")} % 4)::BIGINT AS a FROM labels) GROUP BY 1""",
    "argmax_examples": f"""WITH j AS (SELECT doc_id, source, quality, ({HASH_SQL.format("doc_id::VARCHAR || '::score'")} % 101)::BIGINT AS s FROM documents JOIN labels USING (doc_id))
        SELECT source, arg_max(doc_id, (s, doc_id)) FILTER (WHERE quality = 1) AS best_approved, arg_min(doc_id, (s, doc_id)) FILTER (WHERE quality = 0) AS worst_rejected
        FROM j GROUP BY source""",
    "doc_distribution": "SELECT role, count(*) AS n_messages, count(DISTINCT conv_id) AS n_conversations FROM conversations GROUP BY role",
    "manifest_digest": f"""SELECT source, count(*) AS n_rows, sum(strlen(coalesce(text, '')))::BIGINT AS n_bytes,
        sum({HASH_SQL.format("doc_id::VARCHAR || chr(1) || sha256(coalesce(text, ''))")}::HUGEINT)::VARCHAR AS digest FROM documents GROUP BY source""",
    "source_rollup": "SELECT lang, source, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars, grouping_id(lang, source)::BIGINT AS level FROM documents GROUP BY ROLLUP (lang, source)",
    "stratified_sample": "SELECT doc_id, lang, source, n_chars, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 2",
}
