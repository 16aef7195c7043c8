"""Line dedup by a deletion-neighbourhood join: of lines within one edit, the earliest stays.

Lines (split at the line feed) are compared trimmed and in lower case. A line that
is not empty goes if an earlier line (by document id, then line number; removed or
not) is equal, however short it is. A line of ``MIN_CHARS`` characters or more also
goes if an earlier one of that length is one edit away. The edit grows with the line: if
the longer of the two has ``MIN_WORDS`` words (pieces between single spaces) or more, it
is a word that was substituted, is missing or was added; else a character.

1. Equal lines collapse to their first occurrence (partial aggregation, so a
   line that is everywhere costs a row for each task).
2. A line within one edit of another shares its first or its second half with
   it, the halves being those of the shorter one's length in words or characters.
   Lines that share no half with another are done.
3. The others emit the variants of their deletion neighbourhood as hashed keys:
   the line itself, and the line less one word or character for each place at which
   the edit can lie. Equal variants are joined by aggregation: lines that lack the
   same place are substitutions of each other, and a line that equals another's
   variant is one insertion away, so the earliest of each kind is all that a
   line needs and no pairs are listed.
4. The edit distance between each line and the earliest partner is verified.

Nulls count as empty texts, and an empty table gives no rows. Rows that share a document
id are one document: a line equal in place and content is the same occurrence. Rows
without an id come before all others, in the order of a hash of their texts; those with
equal texts are one document. Texts keep the untouched form of the lines that stay; a
text may become empty. Columns of other names pass through and may have any name that
doesn't begin with two underscores. A text of n lines takes time in proportion to n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm.common import column_blocks, table, text_or_empty, written

#: Characters from which lines are compared up to an edit, and words from which the edit is a word.
MIN_CHARS, MIN_WORDS = 24, 8
TRIM = " \t\r\x0b\f"


def compared(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(TRIM)))


def _hashes(line: Column) -> tuple[Column, Column]:
    """128 bits of a compared line."""
    return F.xxhash64(line), F.xxhash64(F.lit(7), line)


def _document(doc_id: str, text: str) -> tuple[Column, Column]:
    """What numbers a document: its id, and its text's hash if it has none."""
    doc = F.col(f"`{doc_id}`")
    return doc, F.when(doc.isNull(), F.xxhash64(text_or_empty(text))).otherwise(F.lit(0).cast("long"))


WORD, HEAD = 2, 1


def _halves(line: Column, length: Column, word: bool) -> Column:
    """The shared-half keys of a line: those of its own length and of one less. The last two bits say whether it is of words and a first half."""
    made = []
    for back in (0, 1):
        size = length - back
        half = F.floor(size / 2).cast("int")
        if word:
            parts = tuple(F.call_function("substring_index", line, F.lit(" "), n) for n in (half, half - size))
        else:
            parts = F.substring(line, F.lit(1), half), F.substring(line, length - (size - half) + 1, size - half)
        for head, part in zip((True, False), parts, strict=True):
            made.append(F.xxhash64(size, part).bitwiseAND(~3).bitwiseOR(WORD * word + HEAD * head))
    return F.array(*made)


def first_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each distinct line: ``h1``, ``h2``, ``first`` (doc, sig, pos) and, of lines that are long enough, the half keys."""
    doc, sig = _document(doc_id, text)
    lines = docs.select(doc.alias("doc"), sig.alias("sig"), F.posexplode(F.split(text_or_empty(text), "\n")).alias("pos", "line"))
    lines = lines.select("doc", "sig", "pos", compared(F.col("line")).alias("line")).where("line <> ''")
    lines = lines.withColumns({"chars": F.length("line"), "words": F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1})
    h1, h2 = _hashes(F.col("line"))
    near = F.col("chars") >= MIN_CHARS
    by_word, by_char = _halves(F.col("line"), F.col("words"), True), _halves(F.col("line"), F.col("chars"), False)
    halves = F.when(near & (F.col("words") >= MIN_WORDS), by_word).when(near & (F.col("words") < MIN_WORDS - 1), by_char).when(near, F.concat(by_word, by_char))
    keyed = lines.select(h1.alias("h1"), h2.alias("h2"), F.struct("doc", "sig", "pos", halves.alias("halves")).alias("first"))
    return keyed.groupBy("h1", "h2").agg(F.min("first").alias("first")).select("h1", "h2", F.struct("first.doc", "first.sig", "first.pos").alias("first"), "first.halves")


def candidates(lines: DataFrame) -> DataFrame:
    """The lines that share a half with another, of words or of characters: whether they share a first (``head``) or a second half (``tail``)."""
    # the many keys travel with 64 bits of their line only; what is found gets the rest back
    halves = lines.where("halves is not null").select("h1", F.explode("halves").alias("key"))
    # a line has a key once or, with equal halves, in rows of its own: distinct lines are counted by their bounds
    shared = halves.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b").select("key")
    hit = halves.join(shared, "key", "left_semi")
    head = F.col("key").bitwiseAND(HEAD) != 0
    found = hit.groupBy("h1", (F.col("key").bitwiseAND(WORD) != 0).alias("word")).agg(F.max(head).alias("head"), F.max(~head).alias("tail"))
    return found.join(lines.select("h1", "h2", "first"), "h1").select("h1", "h2", "word", "first", "head", "tail")


def with_lines(found: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``found`` with the compared line, read again from its first occurrence."""
    wanted = found.groupBy(F.col("first.doc").alias("__doc"), F.col("first.sig").alias("__of")).agg(F.collect_list(F.struct("h1", "h2", "word", "first", "head", "tail")).alias("__wanted"))
    doc, sig = _document(doc_id, text)
    there = docs.select(doc.alias("__id"), sig.alias("__sig"), text_or_empty(text).alias("__text")).join(wanted, F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__sig") == F.col("__of")))
    fields = found.select("h1", "h2", "word", "first", "head", "tail").schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in column_blocks(batch.column(0)):
                lists = batch.column(1).slice(a, b - a)
                rows = lists.flatten()
                texts = [t.split("\n") for t in batch.column(0).slice(a, b - a).to_pylist()]
                owner, pos = np.repeat(np.arange(b - a), lists.value_lengths().to_numpy()), rows.field("first").field("pos").to_numpy()
                lines = [texts[i][p] if p < len(texts[i]) else "" for i, p in zip(owner.tolist(), pos.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(rows.field(f.name) for f in fields), pa.array(lines, pa.string())], names=[*(f.name for f in fields), "line"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", line string"
    rows = there.select("__text", "__wanted").mapInArrow(run, schema).withColumn("line", compared(F.col("line")))
    h1, h2 = _hashes(F.col("line"))
    return rows.where((h1 == F.col("h1")) & (h2 == F.col("h2"))).dropDuplicates(["h1", "h2", "word"])


def units(line: str, word: bool) -> np.ndarray:
    """A number for each word or character."""
    if word:
        return np.array([xxhash.xxh3_64_intdigest(w) for w in line.split(" ")], np.uint64)
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


def variant_hashes(codes: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Two hashes of the line less the unit at each place of ``begin``..``end``, then of the line itself.

    Polynomials modulo 2**64, from sums over the units before and after the place: linear in the line.
    """
    out = np.empty((2, end - begin + 1), np.uint64)
    for row, base in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
        powers = np.full(len(codes), base, np.uint64)
        powers[:1] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(codes * powers, dtype=np.uint64)]
        inverse = np.uint64(pow(base, -1, 1 << 64))
        out[row, :-1] = sums[begin:end] + (sums[-1] - sums[begin + 1 : end + 1]) * inverse
        out[row, -1] = sums[-1]
    return out


def variants(lines: DataFrame) -> DataFrame:
    """``v1``, ``v2`` (hashed variant), ``size``, ``word``, ``place`` (-1: the line itself), and the line's ``h1``, ``h2``, ``first``."""
    source = lines.select("h1", "h2", "first", "head", "tail", "line", "word")
    schema = lines.select("h1", "h2", "first").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            lines_, head, tail, word = (batch.column(i).to_pylist() for i in (5, 3, 4, 6))
            while begin < len(lines_):  # slices of bounded size, or of one line
                parts, rows, size = [], [], 0
                for i in range(begin, len(lines_)):
                    codes = units(lines_[i], word[i])
                    n = len(codes)
                    if parts and size + n > 500_000:
                        break
                    # with a first half in common the edit lies behind the shorter class's half; else before the second half
                    low = 0 if tail[i] else (n - 1) // 2
                    high = n if head[i] else min(n, n // 2 + 1)
                    if word[i] and n < MIN_WORDS:  # only the shorter line of a pair
                        low = high = 0
                    v = variant_hashes(codes, low, high)
                    parts.append((v, np.r_[np.arange(low, high), -1], np.r_[np.full(high - low, n - 1), n]))
                    rows.append(np.full(v.shape[1], i))
                    size += n
                begin += len(parts)
                v, place, length = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v[0].view(np.int64)), pa.array(v[1].view(np.int64)), pa.array(length.astype(np.int32)), pa.array(place.astype(np.int32)), batch.column(6).take(take), *(batch.column(i).take(take) for i in range(3))],
                    names=["v1", "v2", "size", "place", "word", "h1", "h2", "first"],
                )

    head_fields = "v1 long, v2 long, size int, place int, word boolean, "
    return source.mapInArrow(run, head_fields + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields))


def one_edit(a: str, b: str) -> bool:
    """Whether the lines are one edit apart, in the unit of the longer one."""
    word = max(a.count(" "), b.count(" ")) + 1 >= MIN_WORDS
    x, y = sorted((a.split(" "), b.split(" ")) if word else (a, b), key=len)
    if len(y) - len(x) > 1:
        return False
    i = 0
    while i < len(x) and x[i] == y[i]:
        i += 1
    return i < len(y) and x[i + (len(x) == len(y)) :] == y[i + 1 :]


def near_removed(found: DataFrame) -> DataFrame:
    """(``h1``, ``h2``) of the lines that have an earlier line one edit away. ``found``: candidates with their lines."""
    v = written(variants(found), "line-variants")  # read four times
    me = F.struct("first", "h1", "h2")
    key = ["v1", "v2", "size", "word"]
    # lines that lack the same place: the earliest of them
    lacking = v.where("place >= 0")
    same = lacking.groupBy(*key, "place").agg(F.min(me).alias("least"), F.max(me).alias("most")).where("least.first < most.first")
    by_place = lacking.join(same.select(*key, "place", "least"), [*key, "place"]).select("first", "h1", "h2", "least")
    # a line and those that hold one unit more
    both = v.groupBy(*key).agg(F.min(F.when(F.col("place") < 0, me)).alias("whole"), F.min(F.when(F.col("place") >= 0, me)).alias("longer")).where("whole is not null and longer is not null")
    by_size = v.join(both, key).select("first", "h1", "h2", F.when(F.col("place") < 0, F.col("longer")).otherwise(F.col("whole")).alias("least"))
    partner = by_place.unionByName(by_size).where("least.first < first").groupBy("h1", "h2").agg(F.min("least").alias("least"))
    once = found.select("h1", "h2", "line").dropDuplicates(["h1", "h2"])
    a = once.withColumnRenamed("line", "mine")
    b = once.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("line").alias("other"))
    pairs = partner.select("h1", "h2", F.col("least.h1").alias("p1"), F.col("least.h2").alias("p2")).join(a, ["h1", "h2"]).join(b, ["p1", "p2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [one_edit(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return pairs.select("h1", "h2", "mine", "other").mapInArrow(run, "h1 long, h2 long")


def _place_key(pos: Column, h1: Column) -> Column:
    """A line in its place: the place above 32 bits of the line."""
    return F.shiftleft(pos.cast("long"), 32).bitwiseOR(h1.bitwiseAND(0xFFFFFFFF))


def staying(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(``doc``, ``sig``, ``kept``): for each document with lines that stay, a key of each of these."""
    lines = written(first_lines(docs, doc_id, text), "first-lines")
    found = written(with_lines(candidates(lines), docs, doc_id, text), "near-lines")
    gone = near_removed(found)
    stay = lines.select("h1", "h2", "first").join(gone, ["h1", "h2"], "left_anti")
    return stay.groupBy(F.col("first.doc").alias("doc"), F.col("first.sig").alias("sig")).agg(F.collect_list(_place_key(F.col("first.pos"), F.col("h1"))).alias("kept"))


def _with_gone(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with ``__gone``: the numbers of the lines that go, in order."""
    kept = staying(docs, doc_id, text).select(F.col("doc").alias("__doc"), F.col("sig").alias("__of"), F.col("kept").alias("__kept"))
    doc, sig = _document(doc_id, text)

    def key(line: Column, pos: Column) -> Column:
        c = compared(line)
        return F.when(c != "", _place_key(pos, F.xxhash64(c)))

    keyed = docs.withColumns({"__sig": sig, "__keys": F.transform(F.split(text_or_empty(text), "\n"), key)})
    joined = keyed.join(kept, doc.eqNullSafe(F.col("__doc")) & (F.col("__sig") == F.col("__of")), "left")
    gone = F.array_except(F.array_compact("__keys"), F.coalesce("__kept", F.array().cast("array<bigint>")))
    return joined.withColumn("__gone", F.transform(gone, lambda k: F.shiftright(k, 32).cast("int")))


def remove_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines that go; all rows and columns stay."""
    marked = _with_gone(docs, doc_id, text)
    names = docs.columns
    place = names.index(text)
    source = marked.select(*(F.col(f"`{c}`") for c in names), "__gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            for a, b in column_blocks(column):
                part = batch.slice(a, b - a)
                texts = part.column(place).to_pylist()
                for i, gone in enumerate(part.column(len(names)).to_pylist()):
                    if gone:
                        lines, out = texts[i].split("\n"), set(gone)
                        texts[i] = "\n".join([x for n, x in enumerate(lines) if n not in out])
                columns = part.columns[: len(names)]
                columns[place] = pa.array(texts, column.type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines removed, and the numbers of the removed lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = _with_gone(docs, "doc_id", "text")
    return marked.select("doc_id", F.size("__keys").cast("long").alias("n_lines"), F.size("__gone").cast("long").alias("n_removed"), F.array_join(F.col("__gone").cast("array<string>"), ",").alias("removed_lines"))


SQL = f"""
WITH l AS (SELECT doc_id, generate_subscripts(s, 1) - 1 AS pos, unnest(s) AS raw FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
c AS (SELECT doc_id, pos, lower(trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12))) AS line FROM l),
d AS (SELECT line, length(line) AS chars, length(line) - length(replace(line, ' ', '')) + 1 AS words, min((doc_id, pos)) AS f FROM c WHERE line <> '' GROUP BY line),
u AS (SELECT line, false AS word, chars AS n, string_split(line, '') AS a FROM d WHERE chars >= {MIN_CHARS} AND words < {MIN_WORDS}
      UNION ALL SELECT line, true, words, string_split(line, ' ') FROM d WHERE chars >= {MIN_CHARS} AND words >= {MIN_WORDS} - 1),
k AS (SELECT line, word, n, a, size, part, CASE WHEN part = 0 THEN a[1:size // 2] ELSE a[n - (size - size // 2) + 1:] END AS half
      FROM (SELECT *, n - unnest([0, 0, 1, 1]) AS size, unnest([0, 1, 0, 1]) AS part FROM u)),
p AS (SELECT DISTINCT x.word, x.line AS x, y.line AS y, x.a AS xa, y.a AS ya, x.n AS xn, y.n AS yn FROM k x JOIN k y ON x.word = y.word AND x.size = y.size AND x.part = y.part AND x.half = y.half AND x.line <> y.line
      WHERE x.n <= y.n AND y.n - x.n <= 1 AND (NOT x.word OR y.n >= {MIN_WORDS})),
e AS (SELECT x, y FROM p WHERE CASE WHEN xn = yn THEN len(list_filter(range(1, xn + 1), lambda i: xa[i] <> ya[i])) = 1
        ELSE len(list_filter(range(1, yn + 1), lambda i: list_concat(ya[1:i - 1], ya[i + 1:]) = xa)) > 0 END),
both_ways AS (SELECT x AS line, y AS other FROM e UNION SELECT y, x FROM e),
near AS (SELECT DISTINCT b.line FROM both_ways b JOIN d m ON m.line = b.line JOIN d o ON o.line = b.other WHERE o.f < m.f),
g AS (SELECT c.doc_id, c.pos FROM c JOIN d USING (line) LEFT JOIN near USING (line) WHERE (c.doc_id, c.pos) <> d.f OR near.line IS NOT NULL)
SELECT t.doc_id, t.n AS n_lines, coalesce(r.n, 0) AS n_removed, coalesce(r.places, '') AS removed_lines
FROM (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id) t
LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS places FROM g GROUP BY doc_id) r USING (doc_id)
"""
