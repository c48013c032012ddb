"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if v is not None and type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir) -> tuple[str, float]:
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return (f"rows={len(got)}", took)
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return (f"COLUMNS {sorted(df.columns)} vs {sorted(names)}", took)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return (f"COUNT {len(a)} vs {len(b)}", took)
    for x, y in zip(a, b):
        if x != y:
            return (f"DIFF {x} vs {y}", took)
    return ("ok" if a else "ok-EMPTY", took)
