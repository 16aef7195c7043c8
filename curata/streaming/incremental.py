"""Incremental arrival of rows: a file stream into a table, each key once, and windowed counts with late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_jsonl(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int = 100) -> DataFrame:
    """A stream of JSON line files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def new_rows(stream: DataFrame, key: str = "job_id") -> DataFrame:
    """The first row of each key, whatever batch it comes in: Spark keeps the keys in its state store, partitioned, and nothing is read back."""
    return stream.dropDuplicates([key])


def append_new(stream: DataFrame, target: str, checkpoint: str, key: str = "job_id") -> None:
    """Appends the rows of new keys, and ends when all files are read.

    The file sink's log makes a batch that runs again after a failure add nothing twice.
    """
    sink = new_rows(stream, key).writeStream.format("parquet").outputMode("append")
    sink.option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def resume(jobs: DataFrame, done: DataFrame, key: str = "job_id") -> DataFrame:
    """The jobs of a table that a finished table of results lacks: one shuffle on the key, no list of keys anywhere."""
    return jobs.join(done.select(key).distinct(), key, "left_anti")


def windowed_counts(events: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "2 hours", by: str = "event_type") -> DataFrame:
    """Counts by window and kind; rows later than ``late`` are left out. Works on streams and tables alike."""
    timed = events.withWatermark(time, late) if events.isStreaming else events
    counted = timed.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), by, "n")
