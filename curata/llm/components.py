"""Connected components of an edge table, without collecting it anywhere.

Alternates the two star operations of Kiveris et al. (2014): every round
connects each node's larger neighbours to the smallest node around it. Rounds
are written tables of the shared folder, so lineage stays short and a lost
executor costs one round at most. The number of rounds is logarithmic in
practice; the loop ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import written

MAX_ROUNDS = 60


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Large star (``both``): larger neighbours to the least of all; small star: smaller ones and the node to it."""
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        e = e.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = e.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = e.join(least, "u")
    if both:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(joined.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of (``a``, ``b``) edges that isn't its own root; root: the smallest node reachable.

    Loops, repeated and reversed edges are allowed; an edge with a null is ignored.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    marks = None
    for _ in range(MAX_ROUNDS):
        e = written(_star(_star(e, True), False), "edges")
        new = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == marks:
            break
        marks = new
    else:
        raise RuntimeError(f"components have not settled in {MAX_ROUNDS} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
