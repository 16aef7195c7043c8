"""JSON lines, JSON documents, id lists and file manifests as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None, lineage: bool = False) -> DataFrame:
    """Rows of JSON line files (globs allowed); blank lines are skipped and a malformed line fails the job.

    ``lineage`` adds ``source_path``. With a schema nothing is read twice.
    """
    reader = spark.read.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(list(paths) if not isinstance(paths, str) else paths)
    return df.withColumn("source_path", F.input_file_name()) if lineage else df


def write_jsonl(df: DataFrame, path: str, mode: str = "error", single: bool = False) -> None:
    """One object a line, nulls kept. Spark's commit protocol makes the write atomic; ``single`` is for small results."""
    (df.coalesce(1) if single else df).write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str) -> dict | list:
    """One JSON document (a manifest or report) as plain Python."""
    import json

    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_json(value: dict | list, path: str, spark: SparkSession) -> None:
    """One JSON document, indented by two, on any file system Spark writes; replaces what is there."""
    import json

    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write((json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode())
    out.close()


def read_ids(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(``id``): the distinct lines of id lists that aren't blank, trimmed."""
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    return lines.select(F.trim("value").alias("id")).where("id <> ''").distinct()


def write_ids(df: DataFrame, column: str, path: str, mode: str = "error") -> None:
    df.select(F.col(column).cast("string")).write.mode(mode).text(path)


def only_ids(df: DataFrame, key: str, ids: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of listed ids, in order of the key if limited; an unknown id or an empty result is an error."""
    unknown = [r.id for r in ids.join(df.select(F.col(key).cast("string").alias("id")), "id", "left_anti").limit(10).collect()]
    if unknown:
        raise ValueError(f"unknown ids: {', '.join(sorted(unknown))}")
    found = df.join(ids.select(F.col("id").alias("__id")), F.col(key).cast("string") == F.col("__id"), "left_semi")
    found = found.orderBy(key).limit(limit) if limit is not None else found
    if found.isEmpty():
        raise ValueError("no rows are left")
    return found


def file_manifest(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(``path``, ``size_bytes``, ``sha256``, ``n_rows``): digests of files and their lines that aren't blank."""
    files = spark.read.format("binaryFile").load(list(paths) if not isinstance(paths, str) else paths)
    lines = F.filter(F.split(F.decode("content", "UTF-8"), "\n"), lambda x: F.trim(x) != "")
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), F.size(lines).cast("long").alias("n_rows"))


def row_digest(df: DataFrame) -> str:
    """A digest of a dataset's rows that order and partitioning don't change: the sum of row hashes."""
    row = F.conv(F.substring(F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256), 1, 16), 16, 10).cast("decimal(38,0)")
    r = df.agg(F.sum(row).alias("s"), F.count("*").alias("n")).first()
    return f"{r.n}:{r.s or 0}"


def text_files(spark: SparkSession, glob: str) -> DataFrame:
    """(``path``, ``text``): whole files, for HTML, markdown or plain text."""
    return spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def ingest(files: DataFrame, product: str, language: str, version: str) -> DataFrame:
    """Minimal metadata of raw files: ids from file names, kind from the extension, checksum of the content."""
    name = F.regexp_replace("path", r"^.*/", "")
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    kind = F.when(ext.isin("pdf", "xml", "txt"), ext).when(ext.isin("html", "htm"), "html").otherwise("other")
    stem = F.regexp_replace(name, r"\.[^.]+$", "")
    slug = F.btrim(F.regexp_replace(F.lower(stem), "[^a-z0-9]+", "_"), F.lit("_"))
    return files.select(
        F.concat_ws("_", F.lit(product.lower()), F.lit(language.lower()), slug).alias("doc_id"), F.lit(product).alias("product"), F.lit(language).alias("language"), F.lit(version).alias("version"),
        kind.alias("source_type"), name.alias("source_file"), F.replace("path", F.lit("\\"), F.lit("/")).alias("source_path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("checksum"), F.lit("TODO").alias("import_date"),
    )
