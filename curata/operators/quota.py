"""Quota selection: deal a quota over groups in rounds, in closed form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_robin(df: DataFrame, bucket: Sequence[str], group: str, order: Sequence[Column], turn: Sequence[str], quota: int, keep: str | None = None) -> DataFrame:
    """The first ``quota`` rows of each bucket when its groups take turns.

    Round k takes the k-th best row of each group, groups in the order of
    ``turn``. A row can only be chosen in the first ``quota`` rounds, so the
    second window sees at most ``quota`` rows of each group. ``keep`` names the
    column of a row's place in its bucket.
    """
    in_group = Window.partitionBy(*bucket, group).orderBy(*order)
    ranked = df.withColumn("_round", F.row_number().over(in_group)).where(F.col("_round") <= quota)
    in_bucket = Window.partitionBy(*bucket).orderBy("_round", *turn)
    dealt = ranked.withColumn("_place", F.row_number().over(in_bucket)).where(F.col("_place") <= quota).drop("_round")
    return dealt.withColumnRenamed("_place", keep) if keep else dealt.drop("_place")


def balanced_pick(df: DataFrame, group: str, order: Sequence[Column], n: int, used: DataFrame | None = None) -> DataFrame:
    """``n`` rows picked one by one, each time from the group with the fewest picks so far, in closed form.

    The k-th pick of a group happens when the group has k picks, so rows are
    ordered by the group's earlier picks plus k (``used``: group and ``picked`` of
    former buckets), then k, then ``order``. At most ``n`` rows of a group enter.
    """
    w = Window.partitionBy(group).orderBy(*order)
    ranked = df.withColumn("_k", F.row_number().over(w) - 1).where(F.col("_k") < n)
    if used is not None:
        ranked = ranked.join(used.select(group, F.col("picked").alias("_g")), group, "left").withColumn("_g", F.coalesce("_g", F.lit(0)))
    else:
        ranked = ranked.withColumn("_g", F.lit(0))
    return ranked.orderBy(F.col("_g") + F.col("_k"), "_k", *order).limit(n).drop("_k", "_g")


def picks(*parts: DataFrame, group: str) -> DataFrame:
    """(``group``, ``picked``): how many rows of each group the parts hold."""
    whole = parts[0].select(group)
    for p in parts[1:]:
        whole = whole.unionByName(p.select(group))
    return whole.groupBy(group).agg(F.count("*").alias("picked"))


def _one_of(column: str, values: Sequence[object]) -> Column:
    return F.col(column).isin(list(values)) if values else F.lit(False)


def top_off(rows: DataFrame, seeds: DataFrame, targets: dict[tuple[str, str], int], split: str, task: str, group: str, chunk: str, score: str, key: str, group_first: bool = False) -> DataFrame:
    """Seeds, and rows that fill each bucket of ``targets`` up, in their order.

    ``rows`` are the candidates, materialised (they are read once for each bucket). A candidate
    shares no chunk with what is selected, which is frozen at the bucket's start; candidates
    come in the order of their group's selected rows, then score, group and key (or group,
    score and key). What is
    selected is as small as the targets and kept on the driver. Raises where too few are left.
    """
    spark, columns = rows.sparkSession, rows.columns
    chosen = [r.asDict() for r in seeds.select(columns).collect()]
    for (s, t), target in targets.items():
        inside = (F.col(split) == s) & (F.col(task) == t)
        need = target - sum(r[split] == s and r[task] == t for r in chosen)
        if need <= 0:
            continue
        free = rows.where(inside & ~_one_of(key, [r[key] for r in chosen]) & ~F.coalesce(_one_of(chunk, [r[chunk] for r in chosen]), F.lit(False)))
        taken: dict[object, int] = {}
        for r in chosen:
            taken[r[group]] = taken.get(r[group], 0) + 1
        have = F.coalesce(F.create_map(*(F.lit(x) for kv in taken.items() for x in kv))[F.col(group)], F.lit(0)) if taken else F.lit(0)
        found = free.withColumn("_have", have).orderBy("_have", *((group, F.desc(score)) if group_first else (F.desc(score), group)), key).limit(need).drop("_have").collect()
        if len(found) < need:
            raise ValueError(f"only {len(found)} of {need} rows can be added to {s}/{t}")
        chosen += [r.asDict() for r in found]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in chosen], rows.schema)


def wave(candidates: DataFrame, targets: dict[tuple[str, str], int], tasks: Sequence[str], excluded: DataFrame | None = None, in_turn: Sequence[str] | None = None) -> tuple[DataFrame, dict[tuple[str, str], int]]:
    """A wave of several tasks, and what each bucket lacks.

    ``candidates`` (split, task, doc, chunk, score, tie, turn) are materialised and have at most one
    row a task and chunk. Tasks come in their order; within one, documents take turns
    (see :func:`round_robin`). A chunk that was selected is spent for later tasks; one that
    a task only might have used is not. Splits that share no chunk are dealt at once; where
    they may, ``in_turn`` names their order, each with all its tasks.
    What is selected is as small as the targets and kept on the driver.
    """
    spark = candidates.sparkSession
    pool = candidates if excluded is None else candidates.join(excluded, "chunk", "left_anti")
    chosen: list[tuple] = []
    for splits, t in [([s], t) for s in in_turn for t in tasks] if in_turn else [([s for s, _ in targets], t) for t in tasks]:
        quota = max(n for (s, task), n in targets.items() if task == t and s in splits)
        free = pool.where((F.col("task") == t) & F.col("split").isin(splits) & ~_one_of("chunk", [r[3] for r in chosen]))
        dealt = round_robin(free, ["split"], "doc", [F.desc("score"), F.asc("tie")], ["turn", "doc"], quota, keep="place")
        some = F.lit(False)
        for (s, task), n in targets.items():
            if task == t and s in splits:
                some |= (F.col("split") == s) & (F.col("place") <= n)
        chosen += [tuple(r) for r in dealt.where(some).select("split", "task", "doc", "chunk", "score", "place").collect()]
    lacks = {k: n - sum((r[0], r[1]) == k for r in chosen) for k, n in targets.items()}
    kinds = candidates.schema
    return spark.createDataFrame(chosen, f"split string, task string, doc {kinds['doc'].dataType.simpleString()}, chunk {kinds['chunk'].dataType.simpleString()}, score {kinds['score'].dataType.simpleString()}, place int"), lacks


def chunk_exclusions(*parts: DataFrame, column: str = "source_chunk_ids") -> DataFrame:
    """(``chunk``): the chunks that any row of the parts uses."""
    whole = None
    for p in parts:
        ids = p.select(F.explode(column).alias("chunk"))
        whole = ids if whole is None else whole.unionByName(ids)
    return whole.distinct()


def hash_split(key: Column, modulo: int = 7, remainder: int = 0) -> Column:
    """``eval`` for one in ``modulo`` keys by their stable hash, else ``train``."""
    from curata.functions.hashing import hash_mod

    if modulo <= 1:
        raise ValueError("modulo must be greater than 1")
    return F.when(hash_mod(key, modulo) == remainder, "eval").otherwise("train")


def parse_quota(texts: Sequence[str], defaults: dict[tuple[str, str], int]) -> dict[tuple[str, str], int]:
    """``defaults`` updated by overrides ``task=n`` (both splits) or ``split:task=n``."""
    out = dict(defaults)
    tasks, splits = {t for _, t in defaults}, {s for s, _ in defaults}
    for text in texts:
        name, eq, number = text.partition("=")
        split, colon, task = name.rpartition(":")
        if not eq or not number.strip().isdigit():
            raise ValueError(f"not a quota: {text!r}")
        if task.strip() not in tasks or (colon and split.strip() not in splits):
            raise ValueError(f"unknown task or split: {name!r}")
        for s in [split.strip()] if colon else splits:
            out[s, task.strip()] = int(number)
    return out


def check_quota(df: DataFrame, split: str, task: str, targets: dict[tuple[str, str], int]) -> DataFrame:
    """Buckets whose number of rows differs from the target: must be empty."""
    spark = df.sparkSession
    want = spark.createDataFrame([(s, t, n) for (s, t), n in targets.items()], f"`{split}` string, `{task}` string, target long")
    have = df.groupBy(split, task).agg(F.count("*").alias("n"))
    j = want.join(have, [split, task], "full_outer")
    return j.where(~F.coalesce("n", F.lit(0)).eqNullSafe(F.coalesce("target", F.lit(0))))
