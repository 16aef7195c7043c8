"""The queries of the library and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curata.plans import dialogs, manuals, metrics, quality, reports, reviews, runs, selection

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _module in (selection, metrics, dialogs, reviews, manuals, reports, runs, quality):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["curation_export"](spark, sf_dir)
