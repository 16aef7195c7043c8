"""Sections, packing, chunks, drafts and markdown."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from curata.functions import text as tx
from curata.operators import html, sections
from curata.operators.drafts import drafts


def test_simple_sections(spark):
    df = spark.createDataFrame([(1, "lead\n# A\nx\n\n## B\ny"), (2, "# Only"), (3, "")], "doc_id long, text string")
    got = {(r.doc_id, r.section_id): (r.title, r.content) for r in sections.simple_sections(df).collect()}
    assert got == {
        (1, "sec_0000"): ("Document Start", "lead"), (1, "sec_0001"): ("A", "# A\nx\n"), (1, "sec_0002"): ("B", "## B\ny"),
        (2, "sec_0001"): ("Only", "# Only"), (3, "sec_0000"): ("Document Start", ""),
    }


def test_pack_expression_equals_loop(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([20, 100, 300, 700, 1600, 2500]) for _ in range(rng.randrange(1, 15))]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, sizes array<bigint>")
    got = {r.id: [list(g) for g in r.g] for r in df.select("id", sections.pack_sizes(F.col("sizes")).alias("g")).collect()}
    for i, sizes in rows:
        groups = sections.pack([(1, 1, "x" * n) for n in sizes], sections.MIN_CHARS, sections.TARGET_CHARS, sections.MAX_CHARS)
        assert got[i] == [[len(u[2]) for u in g] for g in groups]


def test_hierarchy_ids_and_paths():
    text = "# Über uns\nx\n## Teil\na\n## Teil\nb\n# Leer\n\n# Über uns\nc"
    found = sections.hierarchy(text, "d")
    assert [s["id"] for s in found] == ["d::sec_ueber_uns", "d::sec_ueber_uns__teil", "d::sec_ueber_uns__teil_02", "d::sec_ueber_uns_02"]
    assert found[2]["path"] == ["Über uns", "Teil"] and found[2]["lines"] == [(6, "b")]


def test_large_blocks_are_divided():
    sentence = "Dies ist ein Satz mit einigen Worten. "
    parts = sections.section_chunks([(1, sentence * 150)])
    assert all(len(p[2]) <= sections.MAX_CHARS for p in parts) and len(parts) > 1
    words = sections.split_large([(4, "w " * 3000)], 1500, 2200)
    assert all(len(u[2]) <= 1500 for u in words) and sum(u[2].count("w") for u in words) == 3000
    items = [(i, f"- item {i} " + "y" * 400) for i in range(1, 12)]
    assert [u[:2] for u in sections.split_large(items, 1500, 2200)][0][0] == 1


def test_chunks_and_drafts(spark):
    body = "# Texterkennung\n\nHinweis: Nur für Bilder. Das geht nur, wenn ein Bild vorliegt. Drücken Sie **F7**, um die Liste zu öffnen.\n\n1. Erster Schritt\n2. Zweiter Schritt\n3. Dritter Schritt\n"
    df = spark.createDataFrame([("m1", body)], "doc_id string, text string")
    chunks = sections.chunks(df)
    c = chunks.collect()[0]
    assert c.chunk_id == "m1::sec_texterkennung::chunk_01" and c.chunk_type == "warning" and c.contains_steps
    assert c.char_count == len(c.content) and c.chunk_count_in_doc == 1 and c.source_span == "m1#L3-L7"
    made = {r.task_type: r for r in drafts(chunks).collect()}
    assert set(made) == {"faq_direct_answer", "step_by_step", "troubleshooting", "clarification", "uncertainty_escalation"}
    assert made["step_by_step"].assistant_message == "1. Erster Schritt\n2. Zweiter Schritt\n3. Dritter Schritt"
    assert made["step_by_step"].score == 44 + 12 + 6
    assert made["clarification"].assistant_message == "Geht es Ihnen um Bilddatei, geoeffnetes PDF, aktuelles Fenster oder Bildschirm oder Kamera oder Scanner?"
    assert made["troubleshooting"].score == 42 + 16 + 10 + 8 + 4
    assert made["uncertainty_escalation"].score == 42 + 18 + 14


def test_markdown():
    page = """<html><head><title>t</title><script>var a="</p>";</script></head><body><nav>no</nav><h1>Titel</h1>
    <div class="toc">no</div><p>Ein <b>fetter</b> Text , mit <a href="x.html">Link</a>.<p>Zwei<br>Zeilen
    <ul><li>eins<li>zwei<ul><li>drei</li></ul></ul><ol start="3"><li>vier</ol><pre>code
  x</pre><blockquote>Zitat</blockquote><table summary="Tasten"><tr><th>A<th>B<tr><td>1</table><div class="src">Quelle: Hilfe</div></body>"""
    title, md = html.to_markdown(page)
    assert title == "Titel"
    assert md == (
        "# Titel\n\nEin **fetter** Text, mit [Link](x.html).\n\nZwei\nZeilen\n\n- eins\n- zwei\n  - drei\n\n3. vier\n\n```\ncode\n  x\n```\n\n> Zitat\n\n"
        "Tabelle: Tasten\n\n| A | B |\n| --- | --- |\n| 1 |  |\n\nQuelle: Hilfe\n"
    )
    assert html.to_markdown("") == ("", "")


def test_markdown_joins_nested_marks_with_a_space():
    _, md = html.to_markdown("<table><tr><td><b>a</b><i>b</i></td><td>c<table><tr><td>d</td></tr></table></td></tr></table><p><b>x<i>y</i></b> z</p><h2>A<b>B</b></h2><h1>A B</h1><blockquote><p>eins</p><p>zwei</p></blockquote><div class='src'>Quelle: <a href='u'>Hilfe</a></div><pre>a<code>b</code></pre>")
    assert md == "| a b | c d | d |\n| --- | --- | --- |\n| d |  |  |\n\n**x y** z\n\n## A B\n\n> eins\n> zwei\n\nQuelle: Hilfe\n\n```\na\nb\n```\n"


def test_files_to_markdown_with_metadata(spark):
    files = spark.createDataFrame([("r/a.HTML", "<h1>T</h1><p>x"), ("r/b.txt", "  plain\n\n"), ("r/c.txt", None)], "path string, text string")
    got = {r.normalized_from: (r.normalized_file, r.markdown) for r in html.normalize_files(files, "v1").collect()}
    assert got == {"r/a.HTML": ("r/a.md", "# T\n\nx\n"), "r/b.txt": ("r/b.md", "plain\n"), "r/c.txt": ("r/c.md", "\n")}
    m = html.manual_metadata(files.withColumn("modified", F.lit("2024-05-06 07:08:09").cast("timestamp")).withColumn("path", F.lit("r/AB_DE_Erste-Schritte.html")), "ab_de_", "P", "de", "c1", "out/", "v1").first()
    assert m.doc_id == "ab_de_erste_schritte" and m.normalized_path == "out/erste_schritte/index.md" and m.import_date == "2024-05-06" and m.source_path == "r" and m.provenance.source_checksum == m.checksum


def test_chunks_keep_what_the_rules_say(spark):
    """The chunks of marked-up documents against the rules, from the chunks and the texts alone."""
    from curata.plans import manuals

    docs = manuals._with_headings(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    texts = {str(r.doc_id): r.text.split("\n") for r in docs.collect()}
    by_doc = {}
    for c in sections.chunks(docs).collect():
        by_doc.setdefault(c.doc, []).append(c)
    assert by_doc
    for doc, found in by_doc.items():
        assert sorted(c.chunk_index for c in found) == list(range(1, len(found) + 1)) and {c.chunk_count_in_doc for c in found} == {len(found)}
        assert len({c.chunk_id for c in found}) == len(found)
        for c in found:
            lines = texts[doc][c.line_start - 1 : c.line_end]
            words = " ".join(lines).split()
            assert sections.MIN_MEANINGFUL <= c.char_count == len(c.content) and c.line_start <= c.line_end
            assert set(c.content.split()) <= set(words)  # nothing is invented, and the span holds it
            assert c.char_count <= sections.MAX_CHARS or c.char_count <= sections.TARGET_CHARS + sections.MAX_CHARS
            titles = [x.lstrip("# ") for x in texts[doc][: c.line_start] if x.startswith("#")]
            assert titles and titles[-1].strip() == c.section_title


def test_drafts_keep_what_the_rules_say(spark):
    """Every draft is one of its chunk's, with a score its task can give, and no artifact in its answer."""
    from curata.plans import manuals

    made = manuals.draft_cases(spark, "/root/testdata/sf0.001").collect()
    least = {"faq_direct_answer": 46, "step_by_step": 44, "troubleshooting": 42, "clarification": 36, "uncertainty_escalation": 42}
    assert made and len({(d.chunk_id, d.task_type) for d in made}) == len(made)
    for d in made:
        assert least[d.task_type] <= d.score <= 90 and d.score % 2 == 0 and d.assistant_message.strip() and "..." not in d.assistant_message and "…" not in d.assistant_message
        if d.task_type == "step_by_step":
            assert [x.split(". ")[0] for x in d.assistant_message.split("\n")] == [str(i + 1) for i in range(len(d.assistant_message.split("\n")))]
        if d.task_type == "clarification":
            assert d.assistant_message.endswith("?")
    jobs = manuals.teacher_jobs(spark, "/root/testdata/sf0.001", quota=3).collect()
    keys = {(d.chunk_id, d.task_type): d for d in made}
    assert jobs and len({j.chunk_id for j in jobs}) == len(jobs) == len({j.job_id for j in jobs})
    assert all(keys[j.chunk_id, j.task_type].assistant_message == j.assistant_message and j.job_id.startswith(f"wave::{j.split}::{j.task_type}::") for j in jobs)
    counts = {}
    for j in jobs:
        counts[j.split, j.task_type] = counts.get((j.split, j.task_type), 0) + 1
    assert max(counts.values()) <= 3


def test_text_functions(spark):
    one = lambda col, **v: spark.createDataFrame([tuple(v.values())], list(v)).select(col.alias("r")).first().r
    assert one(tx.strip_markdown(F.col("t")), t="[a](b) **c** `d`  e_f") == "a c d e f"
    assert one(tx.clean_line(F.col("t")), t="2.  - x - ") == "x"
    assert one(tx.bullets(F.col("t")), t="a\n - b\n- **c**\n") == ["b", "c"]
    assert one(tx.sentences(F.col("t")), t="Eins. Zwei!  3. Drei?") == ["Eins.", "Zwei!", "Drei?"]
    assert one(tx.numbered_steps(F.col("t")), t="1. a\nb\n2. c") == ["a b", "c"]
    assert one(tx.shortcuts(F.col("t")), t="**F1** **Hinweis:** **f1** **F2  x**") == ["F1", "F2 x"]
    assert one(tx.slug(F.col("t")), t="Größe & Maß") == "groesse_mass" and one(tx.slug(F.col("t")), t="!!") == "section"
    assert one(tx.summary(F.col("t"), 10), t="abc def ghi jkl") == "abc def g…"
    assert one(tx.join_snippets(F.col("t"), 9), t=["abc", "def", "ghij"]) == "abc def"
    assert one(tx.words(F.col("t")), t="Die Taste und die TASTE F12 ab") == ["taste", "f12"]


def test_chunk_batches_are_bounded():
    """A worker's memory and its batches don't grow with the batch that it gets; the chunks are those of the documents alone."""
    import tracemalloc

    body = "# Kopf\n\n" + "\n\n".join(f"Absatz {i} mit einigen Worten, die zusammen einen Satz ergeben. " * 4 for i in range(12)) + "\n\n## Zweiter Teil\n\n" + "Noch ein Satz ohne Ende. " * 30
    most, peaks = 40_000, []
    for n in (100, 1600):
        docs = [str(i) for i in range(n)]
        batch = pa.RecordBatch.from_arrays([pa.array(docs), pa.array([body] * n)], names=["doc", "body"])
        tracemalloc.start()
        rows = 0
        for made in sections.chunk_batches(iter([batch]), most):
            assert sum(map(len, made.column("content").to_pylist())) <= most
            rows += made.num_rows
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert rows == n * len(sections.document_chunks("0", body))
    assert peaks[1] < 2 * peaks[0]


def test_chunks_of_a_batch_equal_those_of_each_document(spark):
    """Documents without an id, a text or a heading, a long one between short ones, and blocks of one document."""
    texts = [None, "", "no heading " * 20, "# A\n\n" + "Ein Satz. " * 20, "# B\n\n" + "Viele Sätze. " * 5000 + "\n# B\n\n" + "x" * 90, "## ü\n\n- a\n- b\n" + "z " * 60]
    rows = [(None if i == 3 else str(i), t) for i, t in enumerate(texts)]
    want = [r for doc, t in rows for r in sections.document_chunks(doc, t or "")]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows]), pa.array([t or "" for _, t in rows])], names=["doc", "body"])
    for most in (1, 3000, 1 << 20):
        assert [tuple(r.values()) for b in sections.chunk_batches(iter([batch]), most) for r in b.to_pylist()] == [(*r[:3], list(r[3]), *r[4:]) for r in want]
    got = sections.chunks(spark.createDataFrame(rows, "doc_id string, text string")).select(*sections.CHUNK_FIELDS.names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and {r[5] for r in want if r[0] == "4"} == set(range(1, sum(r[0] == "4" for r in want) + 1))
