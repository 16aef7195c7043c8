"""Data operations around training: freeze checks, raw and normalized pairs, token lengths and label masks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts of a name that say that a dataset isn't final, and the label of tokens that aren't learned.
NOT_FINAL = ("demo", "fixture", "stub")
IGNORED = -100


def not_final(name: Column) -> Column:
    """Whether a name marks its dataset as provisional."""
    low = F.lower(F.coalesce(name, F.lit("")))
    return low.contains(NOT_FINAL[0]) | low.contains(NOT_FINAL[1]) | low.contains(NOT_FINAL[2])


def freeze_faults(manifest: dict, rows: dict[str, DataFrame], digests: dict[str, str], spark) -> DataFrame:
    """(``reason``): what contradicts a frozen export. ``rows``: train, eval and their metadata; ``digests``: those that the files have now."""
    found = [f"provisional name: {n}" for n in (manifest.get("export_id", ""), *manifest.get("source_train_files", ()), *manifest.get("source_eval_files", ())) if any(t in n.casefold() for t in NOT_FINAL)]
    n = {k: df.count() for k, df in rows.items()}
    found += [f"{k} is empty" for k in ("train", "eval") if not n[k]]
    found += [f"{k} and its metadata differ in number" for k in ("train", "eval") if n[k] != n[f"{k}_metadata"]]
    found += [f"manifest has another number of {k} records" for k in ("train", "eval") if manifest.get(f"{k}_records") != n[k]]
    found += [f"digest of {k} differs" for k, d in digests.items() if manifest.get("digests", {}).get(k) not in (None, d)]
    if manifest.get("split_chunk_overlap"):
        found.append("splits share chunks")
    return spark.createDataFrame([(x,) for x in found], "reason string")


def pair_faults(raw: DataFrame, normalized: DataFrame, product: str, language: str) -> DataFrame:
    """(``stem``, ``reason``): raw files (``stem``, ``source_file``) without their normalized document and the reverse, metadata that contradicts, repeated ids."""
    n = normalized.withColumn("_there", F.lit(True))
    j = raw.select("stem", F.col("source_file").alias("_raw"), F.lit(True).alias("_given")).join(n, "stem", "full_outer")
    there, given = F.col("_there").isNotNull(), F.col("_given").isNotNull()
    wrong = lambda c, v: there & given & ~F.coalesce(c == v, F.lit(False))
    reasons = F.array_compact(
        F.array(
            F.when(~there, "not normalized"), F.when(~given, "no raw file"), F.when(wrong(F.col("source_file"), F.col("_raw")), "another source file"), F.when(wrong(F.col("product"), F.lit(product)), "another product"),
            F.when(wrong(F.col("language"), F.lit(language)), "another language"), F.when(wrong(F.col("conversion_stage"), F.lit("raw_html_to_normalized_markdown")), "another stage"),
        )
    )
    single = j.select("stem", F.explode(reasons).alias("reason"))
    twice = n.groupBy("doc_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("stem")).alias("stems")).where("n > 1")
    return single.unionByName(twice.select(F.explode("stems").alias("stem"), F.lit("repeated id").alias("reason")))


Encode = Callable[[list[str]], list[list[int]]]


def chat_text(messages: Column, open_answer: bool = False) -> Column:
    """Messages as one text, a role's mark before each; ``open_answer`` ends with the mark of an answer to come."""
    turns = F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["content"], F.lit("\n"))), "")
    return F.concat(turns, F.lit("<|assistant|>\n")) if open_answer else turns


def training_rows(records: DataFrame, make_encoder: Callable[[], Encode], max_length: int, answers_only: bool = True) -> DataFrame:
    """(``id``, ``input_ids``, ``labels``, ``n_tokens``, ``n_prompt``, ``truncated``): tokens of chats, the prompt's labels masked. A row whose whole answer is cut off fails."""
    texts = records.select("id", chat_text(F.col("messages")).alias("full"), chat_text(F.slice("messages", 1, F.size("messages") - 1), True).alias("prompt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        for batch in batches:
            full, prompt = (encode(batch.column(i).to_pylist()) for i in (1, 2))
            ids = [x[:max_length] for x in full]
            n_prompt = [min(len(p), max_length, len(x)) for p, x in zip(prompt, ids, strict=True)]
            labels = [[IGNORED] * p + x[p:] if answers_only else x for p, x in zip(n_prompt, ids, strict=True)]
            for name, x in zip(batch.column(0).to_pylist(), labels, strict=True):
                if answers_only and all(v == IGNORED for v in x):
                    raise ValueError(f"{name} has no token of its answer within {max_length}")
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, lists), pa.array(labels, lists), pa.array([len(x) for x in ids], pa.int64()), pa.array(n_prompt, pa.int64()), pa.array([len(x) > max_length for x in full], pa.bool_())], names=["id", "input_ids", "labels", "n_tokens", "n_prompt", "truncated"])

    return texts.mapInArrow(run, "id string, input_ids array<int>, labels array<int>, n_tokens long, n_prompt long, truncated boolean")


def token_stats(rows: DataFrame, column: str = "n_tokens") -> DataFrame:
    """One row: number, mean, median, nearest-rank percentiles and maximum of token lengths, and how many were cut."""
    rank = lambda p: F.expr(f"cast(percentile_disc({p}) WITHIN GROUP (ORDER BY {column}) AS bigint)")
    return rows.agg(F.count("*").alias("rows"), F.round(F.avg(column), 2).alias("mean"), F.median(column).alias("median"), rank(0.95).alias("p95"), rank(0.99).alias("p99"), F.max(column).alias("max"), F.count_if("truncated").alias("truncated"))


def gate(flagged: int, most: int | None, what: str = "flagged rows") -> None:
    """Raises if there are more flagged rows than a gate allows; no gate where ``most`` is None."""
    if most is not None and flagged > most:
        raise ValueError(f"{flagged} {what}, {most} allowed")


def run_paths(run: str, artifacts: Sequence[str], folder: str) -> dict[str, str]:
    """Conventional paths of a run's artifacts; an artifact that is a path already stays."""
    return {a: a if "/" in a else f"{folder}/{run}_{a}.jsonl" for a in artifacts}


def fresh_run(existing: Sequence[str], resume: bool) -> None:
    """A run may not take the name of another whose artifacts are there, unless it resumes it."""
    if existing and not resume:
        raise ValueError(f"there already: {', '.join(sorted(existing))}")
