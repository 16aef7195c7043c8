"""Session and table helpers shared by the queries of the library."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    shared = os.environ.get("CURATA_SHARED_DIR") or tempfile.mkdtemp(prefix="curata-")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("curata")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CURATA_DRIVER_MEMORY", "6g"))
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; the path may be of any file system Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frozen(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder: a later read sees the same rows, whatever executor is lost."""
    spark = df.sparkSession
    context = spark.sparkContext._jsc.sc()
    if not context.getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not named:
            named = tempfile.mkdtemp(prefix="curata-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return df.checkpoint()
