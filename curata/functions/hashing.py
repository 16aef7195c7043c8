"""Stable hashes that agree across engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(col: Column) -> Column:
    """The first 16 hex digits of a SHA-256 as an unsigned number (decimal, as a bigint would overflow)."""
    return F.conv(F.substring(F.sha2(col.cast("string"), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def hash_mod(col: Column, modulo: int) -> Column:
    return F.pmod(stable_hash(col), F.lit(modulo)).cast("bigint")
