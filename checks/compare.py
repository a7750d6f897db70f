"""Run queries in Spark and DuckDB and compare rows: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

from checks import registry
from duologue import build_session


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)) and not isinstance(value, bool):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def kinds(columns: list[str], data) -> dict[str, list[str]]:
    """Python types found in each column."""
    return {c: sorted({type(r[i]).__name__ for r in data} - {"NoneType"}) for i, c in enumerate(columns)}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, folder: str, name: str) -> tuple[str, int, float, str]:
    query, sql = registry.queries()[name], registry.oracle_sql().get(name)
    begin = time.time()
    df = query(spark, folder)
    got = df.collect()
    spent = time.time() - begin
    if sql is None:
        return "rows-only", len(got), spent, ""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return "COLUMNS", len(got), spent, f"{sorted(df.columns)} != {sorted(names)}"
    a, b = rows(df.columns, got), rows(names, want)
    if a == b:
        mine, theirs = kinds(df.columns, got), kinds(names, want)
        mixed = {k: (mine[k], theirs[k]) for k in mine if mine[k] != theirs.get(k)}
        return "ok", len(got), spent, f"types differ: {mixed}" if mixed else ""
    only_a = [r for r in a if r not in b][:2] if len(a) < 20000 else a[:2]
    only_b = [r for r in b if r not in a][:2] if len(b) < 20000 else b[:2]
    return "DIFF", len(got), spent, f"{sorted(names)} {len(a)} vs {len(b)}\n  spark {str(only_a)[:700]}\n  sql   {str(only_b)[:700]}"


def main() -> int:
    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.001'}"
    wanted = sys.argv[2:]
    names = [n for n in registry.queries() if not wanted or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    spark = build_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        try:
            state, n, spent, note = compare(spark, con, folder, name)
        except Exception as problem:
            state, n, spent, note = "ERROR", 0, 0.0, f"{type(problem).__name__}: {str(problem)[:900]}"
        bad += state in ("DIFF", "COLUMNS", "ERROR")
        print(f"{state:10s} {name:34s} rows={n:<8d} {spent:6.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
