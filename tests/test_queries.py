"""Every query of the library agrees with its SQL, or runs."""

import pytest
from oracle import DATA, compare

from curata.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_agrees_with_sql(spark, name):
    compare(spark, registry.QUERIES[name], registry.ORACLES[name])


#: Queries that SQL can't express: their results are checked in test_manuals, against the rules.
WITHOUT_SQL = {"chunk_violations", "draft_cases", "hierarchical_chunks", "html_normalize", "page_line_rules", "teacher_jobs"}


def test_all_others_have_sql():
    assert set(registry.QUERIES) - set(registry.ORACLES) == WITHOUT_SQL


def test_chunks_have_no_faults(spark):
    assert registry.QUERIES["chunk_violations"](spark, f"{DATA}/sf0.001").collect() == []


def test_pages_to_markdown(spark):
    """Titles and checksums of real pages against the pages themselves."""
    import hashlib
    import html as html_lib
    import re

    from curata.operators.html import to_markdown

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/sf0.001/pages.parquet").collect()}
    got = {r.page_id: r for r in registry.QUERIES["html_normalize"](spark, f"{DATA}/sf0.001").collect()}
    assert got.keys() == pages.keys()
    for i, page in pages.items():
        title = " ".join(html_lib.unescape(re.sub("<[^>]*>", "", re.search("(?s)<h1>(.*?)</h1>", page)[1])).split())
        text = to_markdown(page)[1]
        assert " ".join(got[i].title.split()) == title and got[i].checksum == hashlib.sha256(text.encode()).hexdigest() and got[i].n_chars == len(text)
        assert f"# {title.split()[0]}" in text and "track(" not in text
    assert registry.QUERIES["page_line_rules"](spark, f"{DATA}/sf0.001").where("n > 0").count() == registry.QUERIES["page_line_rules"](spark, f"{DATA}/sf0.001").count()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
