"""Model stages: micro-batches, exchangeable clients, reconciliation, resume and metrics.

The model's computation is external. A client is any object with
``complete(requests) -> responses`` (lists of dicts keyed by ``id``); it is made in
the task that uses it. Offline there are two: ``Stub`` answers from the request
itself and ``Replay`` from recorded rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.operators.numbering import batches


class Stub:
    """Answers each request with its own draft."""

    def complete(self, requests: list[dict]) -> list[dict]:
        return [{"id": r["id"], "text": r.get("draft") or r.get("prompt", "")} for r in requests]


class Replay:
    """Answers from recorded texts by id; what isn't recorded is missing from the response."""

    def __init__(self, recorded: dict[str, str]):
        self.recorded = recorded

    def complete(self, requests: list[dict]) -> list[dict]:
        return [{"id": r["id"], "text": self.recorded[r["id"]]} for r in requests if r["id"] in self.recorded]


@dataclass
class Http:
    """An OpenAI-compatible chat endpoint with a strict response schema; retries on errors of network and format."""

    base: str
    model: str
    key: str
    schema: dict
    attempts: int = 3
    timeout: int = 120
    headers: dict[str, str] = field(default_factory=dict)

    def body(self, requests: list[dict]) -> dict:
        return {
            "model": self.model,
            "messages": [{"role": "user", "content": json.dumps(requests, ensure_ascii=False)}],
            "response_format": {"type": "json_schema", "json_schema": {"name": "responses", "strict": True, "schema": self.schema}},
        }

    def complete(self, requests: list[dict]) -> list[dict]:
        import urllib.error
        import urllib.request

        data = json.dumps(self.body(requests)).encode()
        fault: Exception | None = None
        for _ in range(self.attempts):
            try:
                call = urllib.request.Request(f"{self.base.rstrip('/')}/chat/completions", data, {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json", **self.headers})
                with urllib.request.urlopen(call, timeout=self.timeout) as got:
                    return response_items(json.loads(got.read()))
            except (urllib.error.URLError, ValueError, KeyError) as e:
                fault = e
        raise RuntimeError(f"no valid response after {self.attempts} attempts") from fault


@dataclass
class Cli:
    """A program that reads the requests as JSON on its input and writes the response items to the file that replaces ``{out}`` in its command, or to its output."""

    command: list[str]
    attempts: int = 3
    timeout: int = 600

    def complete(self, requests: list[dict]) -> list[dict]:
        import pathlib
        import subprocess
        import tempfile

        fault: Exception | None = None
        for _ in range(self.attempts):
            with tempfile.TemporaryDirectory() as folder:  # of the one process, gone when it ends
                out = pathlib.Path(folder, "out.json")
                try:
                    ran = subprocess.run([a.replace("{out}", str(out)) for a in self.command], input=json.dumps(requests, ensure_ascii=False), capture_output=True, text=True, timeout=self.timeout, check=True)
                    return json.loads(out.read_text() if out.exists() else ran.stdout)["items"]
                except (subprocess.SubprocessError, OSError, ValueError, KeyError, TypeError) as e:
                    fault = e
        raise RuntimeError(f"no valid response after {self.attempts} attempts") from fault


def response_items(payload: dict) -> list[dict]:
    """The items of a chat response whose content is a string or a list of text parts."""
    content = payload["choices"][0]["message"]["content"]
    if isinstance(content, list):
        content = "".join(p.get("text", "") for p in content)
    return json.loads(content)["items"]


CLIENTS: dict[str, Callable[..., object]] = {"stub": Stub, "replay": Replay, "http": Http, "cli": Cli}


def client(name: str, **options) -> object:
    if name not in CLIENTS:
        raise ValueError(f"unknown client {name!r}; there are {', '.join(sorted(CLIENTS))}")
    return CLIENTS[name](**options)


def with_batches(jobs: DataFrame, size: int, order: str = "job_id", group: str | None = None) -> DataFrame:
    """``jobs`` with a ``batch`` key: consecutive rows in fixed numbers, groups one after the other if given."""
    return batches(jobs, size, order, group).withColumn("batch", F.col("batch").cast("string"))


RESPONSES = "batch string, job_id string, text string, failure string, prompt_chars long, batch_prompt_chars long, batch_size int"


def run_stage(jobs: DataFrame, make_client: Callable[[], object], done: DataFrame | None = None) -> DataFrame:
    """Responses to (``batch``, ``job_id``, ``prompt``, ``draft``) rows, a call for each batch.

    A batch whose returned ids aren't the requested ones fails as a whole, with
    the reason on its rows. ``done`` (job_id, text) rows are kept and not asked again.
    """
    asked = jobs if done is None else jobs.join(done.select("job_id"), "job_id", "left_anti")

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_client()
        for frame in frames:
            batch = frame["batch"].iloc[0]
            ids, prompts = frame["job_id"].tolist(), frame["prompt"].fillna("").tolist()
            requests = [{"id": i, "prompt": p, "draft": d} for i, p, d in zip(ids, prompts, frame["draft"].fillna("").tolist(), strict=True)]
            failure, texts = None, {}
            try:
                texts = {r["id"]: r["text"] for r in model.complete(requests)}
                missing, extra = sorted(set(ids) - set(texts)), sorted(set(texts) - set(ids))
                if missing or extra:
                    failure = "missing: " + ",".join(missing) + "; extra: " + ",".join(extra)
            except Exception as e:  # a failed call is a row's result, not the job's
                failure = f"{type(e).__name__}: {e}"
            total = sum(map(len, prompts))
            share = max(1, round(total / len(ids)))
            yield pd.DataFrame({"batch": batch, "job_id": ids, "text": [None if failure else texts[i] for i in ids], "failure": failure, "prompt_chars": share, "batch_prompt_chars": total, "batch_size": len(ids)})

    columns = asked.select("batch", "job_id", "prompt", "draft")
    made = columns.groupBy("batch").applyInPandas(lambda frame: next(call(iter([frame]))), RESPONSES)
    if done is None:
        return made
    old = done.select(F.lit(None).cast("string").alias("batch"), "job_id", "text", F.lit(None).cast("string").alias("failure"), *(F.lit(0).cast(t).alias(c) for c, t in (("prompt_chars", "long"), ("batch_prompt_chars", "long"), ("batch_size", "int"))))
    return old.join(jobs.select("job_id"), "job_id", "left_semi").select(made.columns).unionByName(made)


def stage_metrics(responses: DataFrame) -> DataFrame:
    """Jobs, failures and average prompt sizes of a stage; averages are 0 where nothing ran."""
    ran = F.col("batch").isNotNull()
    return responses.agg(
        F.count("*").alias("selected_jobs"),
        F.count_if(F.col("failure").isNull()).alias("completed_jobs"),
        F.count_if(F.col("failure").isNotNull()).alias("failed_jobs"),
        F.countDistinct(F.when(ran, F.col("batch"))).alias("executed_batches"),
        F.coalesce(F.sum(F.when(ran, F.col("prompt_chars"))), F.lit(0)).alias("prompt_chars"),
        F.coalesce(F.round(F.avg(F.when(ran, F.col("prompt_chars"))), 2), F.lit(0.0)).alias("avg_prompt_chars"),
    )


def render_prompt(template: str, rules: list[str], **fields) -> Column:
    """A template, its rules and the fields of a case, a line each."""
    parts = [F.lit(template), *(F.lit(f"- {r}") for r in rules), *(F.concat(F.lit(f"{k}: "), F.coalesce(c.cast("string"), F.lit(""))) for k, c in fields.items())]
    return F.concat_ws("\n", *parts)


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key, the last by ``order``."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def require_all(left: DataFrame, right: DataFrame, key: str, what: str) -> DataFrame:
    """``left`` joined with ``right`` by ``key``; an error names keys of ``left`` that ``right`` lacks."""
    gone = [str(r[0]) for r in left.join(right, key, "left_anti").select(key).limit(10).collect()]
    if gone:
        raise ValueError(f"missing {what}: {', '.join(sorted(gone))}")
    return left.join(right, key)
