"""Runs a query and its SQL on the same tables and compares them."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return int(v) if v == int(v) else round(float(v), 9)
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, query, sql, sf="0.001"):
    path = f"{DATA}/sf{sf}"
    df = query(spark, path)
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{path}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    mine, other = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(rel.columns, rel.fetchall())
    assert len(mine) == len(other), (len(mine), len(other))
    for a, b in zip(mine, other, strict=True):
        assert a == b, (a, b)
    return len(mine)
