"""Closed forms against step-by-step selectors."""

import random

import pytest
from pyspark.sql import functions as F

from curata.operators import quota


def test_round_robin_takes_turns(spark):
    rng = random.Random(1)
    rows = [(f"s{rng.randrange(2)}", f"g{rng.randrange(4)}", i, rng.randrange(50)) for i in range(60)]
    df = spark.createDataFrame(rows, "split string, g string, id long, score long")
    got = quota.round_robin(df, ["split"], "g", [F.desc("score"), F.asc("id")], ["g"], 9)
    want = set()
    for split in {r[0] for r in rows}:
        groups = {g: sorted((r for r in rows if r[0] == split and r[1] == g), key=lambda r: (-r[3], r[2])) for g in sorted({r[1] for r in rows if r[0] == split})}
        taken = 0
        while taken < 9 and any(groups.values()):
            for g in sorted(groups):
                if groups[g] and taken < 9:
                    want.add(groups[g].pop(0)[2])
                    taken += 1
    assert {r.id for r in got.collect()} == want


def test_balanced_pick_matches_one_by_one(spark):
    rng = random.Random(2)
    rows = [(f"g{min(rng.randrange(8), 4)}", i, rng.randrange(9)) for i in range(50)]
    used = {"g0": 3, "g4": 1}
    df = spark.createDataFrame(rows, "g string, id long, rank long")
    got = quota.balanced_pick(df, "g", [F.asc("rank"), F.asc("id")], 17, spark.createDataFrame(list(used.items()), "g string, picked long"))
    left, local, want = list(rows), {}, []
    total = dict(used)
    for _ in range(17):
        best = min(left, key=lambda r: (total.get(r[0], 0), local.get(r[0], 0), r[2], r[1]))
        left.remove(best)
        want.append(best[1])
        total[best[0]] = total.get(best[0], 0) + 1
        local[best[0]] = local.get(best[0], 0) + 1
    assert {r.id for r in got.collect()} == set(want)


def test_top_off_equals_bucket_by_bucket(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["eval", "train"]), rng.choice("ab"), f"g{rng.randrange(4)}", i, rng.randrange(20), f"c{rng.randrange(60)}") for i in range(90)]
    targets = {("eval", "a"): 3, ("eval", "b"): 4, ("train", "a"): 5, ("train", "b"): 2}
    df = spark.createDataFrame(rows, "split string, task string, g string, id long, score long, chunk string")
    chosen = rows[:3]
    seeds = spark.createDataFrame(chosen, df.schema)
    want = list(chosen)
    for (s, t), n in targets.items():
        used, have = {r[5] for r in want}, {}
        for r in want:
            have[r[2]] = have.get(r[2], 0) + 1
        free = sorted((r for r in rows if r[:2] == (s, t) and r not in want and r[5] not in used), key=lambda r: (have.get(r[2], 0), -r[4], r[2], r[3]))
        want += free[: max(0, n - sum(r[:2] == (s, t) for r in want))]
    got = quota.top_off(df, seeds, targets, "split", "task", "g", "chunk", "score", "id")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    with pytest.raises(ValueError, match="can be added to train/b"):
        quota.top_off(df, seeds, targets | {("train", "b"): 80}, "split", "task", "g", "chunk", "score", "id")


def test_wave_equals_turns_with_a_carried_used_set(spark):
    rng = random.Random(4)
    tasks = ["x", "y", "z"]
    rows = [("eval" if c % 4 == 0 else "train", t, f"d{c % 5}", c, rng.randrange(9), rng.random(), c % 5 * 7 % 3) for c in range(60) for t in tasks if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "split string, task string, doc string, chunk long, score long, tie double, turn long")
    targets = {("eval", t): n for t, n in zip(tasks, (2, 3, 50), strict=True)} | {("train", t): n for t, n in zip(tasks, (7, 9, 6), strict=True)}
    want, lacks = set(), {}
    for split in ("eval", "train"):
        used = {8, 9}
        for t in tasks:
            pools = {}
            for r in sorted((r for r in rows if r[0] == split and r[1] == t), key=lambda r: (-r[4], r[5])):
                pools.setdefault((r[6], r[2]), []).append(r)
            taken = 0
            while taken < targets[split, t]:
                before = taken
                for d in sorted(pools):
                    while pools[d] and pools[d][0][3] in used:
                        pools[d].pop(0)
                    if pools[d] and taken < targets[split, t]:
                        r = pools[d].pop(0)
                        used.add(r[3])
                        want.add(r[:4])
                        taken += 1
                if taken == before:
                    break
            lacks[split, t] = targets[split, t] - taken
    gone = quota.chunk_exclusions(spark.createDataFrame([([8],), ([9, 8],)], "source_chunk_ids array<long>"))
    got, short = quota.wave(df, targets, tasks, gone)
    assert {tuple(r)[:4] for r in got.collect()} == want and short == lacks and short["eval", "z"] > 0


def test_numbers_are_consecutive_in_groups(spark):
    from curata.operators import numbering

    rows = [(i * 37 % 500, f"g{i % 3}" if i % 7 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string").repartition(5)
    plain = {r.id: r.number for r in numbering.number_rows(df, "id").collect()}
    assert plain == {i: n for n, i in enumerate(sorted(r[0] for r in rows))}
    groups = {}
    for i, g in sorted(rows):
        groups.setdefault(g, []).append(i)
    assert {(r.id, r.number) for r in numbering.number_rows(df, "id", "g").collect()} == {(i, n) for ids in groups.values() for n, i in enumerate(ids)}
    start, want = 0, {}
    for g in sorted(groups, key=lambda g: (g is not None, g)):
        want |= {i: start + n // 8 for n, i in enumerate(groups[g])}
        start += -(-len(groups[g]) // 8)
    assert {r.id: r.batch for r in numbering.batches(df, 8, "id", "g").collect()} == want


def test_quota_overrides():
    base = {("train", "faq"): 3, ("eval", "faq"): 1}
    assert quota.parse_quota(["faq=7"], base) == {("train", "faq"): 7, ("eval", "faq"): 7}
    assert quota.parse_quota(["eval:faq=2"], base)["eval", "faq"] == 2
    for bad in ("faq", "faq=x", "nope=1", "test:faq=1"):
        with pytest.raises(ValueError):
            quota.parse_quota([bad], base)


def test_check_quota_names_wrong_buckets(spark):
    df = spark.createDataFrame([("train", "faq"), ("train", "faq")], "split string, task string")
    bad = quota.check_quota(df, "split", "task", {("train", "faq"): 2, ("eval", "faq"): 1}).collect()
    assert [(r.split, r.task) for r in bad] == [("eval", "faq")]
