"""The queries of the llm operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from curata.llm import bpe, decontamination, gam, html_extract, line_dedup, quality_rules, simhash, suffix_dedup, token_counts, url_filter

QUERIES = {
    "op1_decontamination": decontamination.query,
    "op2_bpe": bpe.query,
    "op3_url_filter": url_filter.query,
    "op4_token_counts": token_counts.query,
    "op5_suffix_dedup": suffix_dedup.query,
    "op6_quality_gam": gam.query,
    "op7_simhash": simhash.query,
    "op8_quality_rules": quality_rules.query,
    "op9_html_extract": html_extract.query,
    "op10_line_dedup": line_dedup.query,
}

ORACLES: dict[str, str] = {"op8_quality_rules": quality_rules.SQL, "op10_line_dedup": line_dedup.SQL}
