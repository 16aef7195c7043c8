"""Constraint checks as rows: JSON-Schema rules, provenance by shape, keys and references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": (T.StringType,),
    "integer": (T.IntegerType, T.LongType, T.ShortType),
    "number": (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType),
    "boolean": (T.BooleanType,),
    "array": (T.ArrayType,),
    "object": (T.StructType, T.MapType),
}


def schema_checks(schema: dict, kind: T.StructType, at: Column | None = None, path: str = "") -> list[Column]:
    """Expressions that give a reason where a struct breaks a JSON Schema, else null.

    Covers required, type (with null), enum, const, minLength, minimum, maximum, minItems, uniqueItems, items and
    properties, nested. A required property that is null counts as absent unless its type admits null.
    """
    out: list[Column] = []
    fields = {f.name: f.dataType for f in kind.fields}
    here = lambda name: at[name] if at is not None else F.col(f"`{name}`")
    for name, rule in schema.get("properties", {}).items():
        full = f"{path}{name}"
        types = rule.get("type", [])
        types = [types] if isinstance(types, str) else types
        needed = name in schema.get("required", [])
        if name not in fields:
            if needed:
                out.append(F.lit(f"{full}: required"))
            continue
        col, have = here(name), fields[name]
        if needed and "null" not in types:
            out.append(F.when(col.isNull(), f"{full}: required"))
        known = [t for t in types if t != "null"]
        if known and not any(isinstance(have, _TYPES[t]) for t in known):
            out.append(F.when(col.isNotNull(), f"{full}: not {'/'.join(known)}"))
            continue
        out += _value_checks(rule, have, col, full)
    return out


def _value_checks(rule: dict, have: T.DataType, col: Column, path: str) -> list[Column]:
    out: list[Column] = []
    if "enum" in rule:
        out.append(F.when(~col.isin([v for v in rule["enum"] if v is not None]), f"{path}: not in enum"))
    if "const" in rule:
        out.append(F.when(col != F.lit(rule["const"]), f"{path}: not the constant"))
    if "minLength" in rule and isinstance(have, T.StringType):
        out.append(F.when(F.length(col) < rule["minLength"], f"{path}: too short"))
    for key, bad in (("minimum", lambda c, v: c < v), ("maximum", lambda c, v: c > v)):
        if key in rule and not isinstance(have, T.StringType):
            out.append(F.when(bad(col, rule[key]), f"{path}: beyond {key}"))
    if isinstance(have, T.ArrayType):
        if "minItems" in rule:
            out.append(F.when(F.size(col) < rule["minItems"], f"{path}: too few items"))
        if rule.get("uniqueItems"):
            out.append(F.when(F.size(F.array_distinct(col)) < F.size(col), f"{path}: repeated items"))
        if "items" in rule:
            # the first reason of any item
            def reason(x: Column) -> Column:
                inner = schema_checks(rule["items"], have.elementType, x, f"{path}[].") if isinstance(have.elementType, T.StructType) else _value_checks(rule["items"], have.elementType, x, f"{path}[]")
                return F.coalesce(*inner) if inner else F.lit(None).cast("string")

            out.append(F.get(F.filter(F.transform(col, reason), lambda r: r.isNotNull()), F.lit(0)))
    if isinstance(have, T.StructType) and "properties" in rule:
        out += [F.when(col.isNotNull(), c) for c in schema_checks(rule, have, col, f"{path}.")]
    return out


def schema_violations(df: DataFrame, schema: dict, key: str) -> DataFrame:
    """(``key``, ``reason``) for each rule of a JSON Schema that a row breaks."""
    checks = schema_checks(schema, df.schema)
    if not checks:
        return df.select(key, F.lit("").alias("reason")).where("false")
    return df.select(key, F.explode(F.array_compact(F.array(*checks))).alias("reason"))


def row_kind(columns: list[str]) -> str:
    """The kind of rows by the columns they have; the first that fits."""
    has = set(columns).issuperset
    for kind, needed in (
        ("sft", {"messages", "meta"}), ("eval", {"prompt", "source_doc_ids"}), ("metadata", {"source_doc_ids", "gold_source_path"}), ("output", {"output_id", "candidate"}),
        ("response", {"output_id", "parsed_response"}), ("job", {"job_id", "runner_input"}),
    ):
        if has(needed):
            return kind
    return "chunk"


#: What provenance each kind of row must carry.
NEEDED = {
    "sft": ["meta.source_doc_ids", "meta.review_status", "provenance.source_records"],
    "eval": ["source_doc_ids", "review_status", "provenance.source_records"],
    "metadata": ["source_doc_ids", "review_status", "gold_source_path", "provenance.source_records"],
    "output": ["source_doc_ids", "source_chunk_ids", "review_status", "provenance.source_records"],
    "response": ["source_doc_ids", "source_chunk_ids", "response_status", "provenance.source_records"],
    "job": ["source_doc_ids", "source_chunk_ids", "review_status", "job_status", "provenance.source_records"],
    "chunk": ["doc_id", "source_spans", "review_status"],
}


def _lookup(kind: T.DataType, path: str) -> T.DataType | None:
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return None
        kind = kind[name].dataType
    return kind


def provenance_violations(df: DataFrame, key: str) -> DataFrame:
    """(``key``, ``reason``): provenance that a row of its kind lacks."""
    checks = []
    for path in NEEDED[row_kind(df.columns)]:
        found = _lookup(df.schema, path)
        if found is None:
            empty = F.lit(True)
        elif isinstance(found, T.ArrayType):
            empty = F.coalesce(F.size(F.col(path)), F.lit(0)) <= 0
        else:
            empty = F.coalesce(F.col(path).cast("string"), F.lit("")) == ""
        checks.append(F.when(empty, f"missing {path}"))
    return df.select(key, F.explode(F.array_compact(F.array(*checks))).alias("reason"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Composite keys of several rows, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def missing_references(df: DataFrame, column: str, target: DataFrame, key: str) -> DataFrame:
    """Values of a column (or of an array's elements) that the target's key lacks."""
    values = F.explode(column) if isinstance(df.schema[column].dataType, T.ArrayType) else F.col(column)
    return df.select(values.alias(key)).where(F.col(key).isNotNull()).distinct().join(target.select(key), key, "left_anti")


def different_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with the side."""
    left = a.select(key).exceptAll(b.select(key)).withColumn("side", F.lit("left"))
    return left.unionByName(b.select(key).exceptAll(a.select(key)).withColumn("side", F.lit("right")))
