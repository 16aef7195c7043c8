"""Helpers of the llm operators: scratch tables, block-wise Arrow maps."""

from __future__ import annotations

import atexit
import re
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import curata.llm

# Executors get the functions themselves, so they need no copy of the package.
cloudpickle.register_pickle_by_value(curata.llm)

#: Characters of text handled at once in a Python worker; bounds its memory whatever the batch.
BLOCK_CHARS = 2_000_000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one where none is set and all runs in one process (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        of_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = of_context.get() if of_context.isDefined() else None
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="curata-scratch-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table of the shared folder and read back: cuts lineage, survives lost executors.

    Results are read from it later, so the table goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def blocks(texts: list[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of at most ``limit`` characters together, or of one text."""
    return _ranges(map(len, texts), limit)


def column_blocks(column: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of a string column of at most ``limit`` bytes together, or of one row; nothing is converted."""
    return _ranges(pc.fill_null(pc.binary_length(column), 0).to_pylist(), limit)


def _ranges(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    start = size = i = 0
    for i, n in enumerate(sizes, 1):
        if i - 1 > start and size + n > limit:
            yield start, i - 1
            start, size = i - 1, 0
        size += n
    if start < i:
        yield start, i


def worker_cache(name: str, version: str, make: Callable[[], object]):
    """What ``make`` returns, kept for later tasks of the same Python worker; of each name only the last version."""
    kept = sys.__dict__.setdefault("_curata_worker_cache", {})
    if name not in kept or kept[name][0] != version:
        kept[name] = (version, make())
    return kept[name][1]


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[str]], dict[str, pa.Array]]],
    columns: list[tuple[str, T.DataType]],
    text: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with columns computed from whole texts (null: empty), block by block.

    ``make`` runs once in each task and returns a function from texts to the
    arrays of ``columns``. Columns of ``df`` in ``keep`` (default: all) pass
    through untouched; a new column takes the place of one of its name.
    """
    new = {n.lower() for n, _ in columns}
    fields = [f for f in df.schema.fields if (keep is None or f.name in keep) and f.name.lower() not in new]
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in columns)])
    names = [n for n, _ in columns]
    count = len(fields)
    place = next((i for i, f in enumerate(fields) if f.name == text and f.dataType == T.StringType()), count)
    extra = [F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text")] if place == count else []  # the text travels once
    source = df.select(*[F.col(f"`{f.name}`") for f in fields], *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            column = batch.column(place)
            for a, b in column_blocks(column):
                made = work([t or "" for t in column.slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:count]), *(made[n] for n in names)], names=[*(f.name for f in fields), *names])

    return source.mapInArrow(run, schema)
