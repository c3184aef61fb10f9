"""Run registered queries next to their SQL twins: python tests/oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as entry
from staylens.catalog.registry import TABLES
from staylens.session import local_session

#: Compare doubles to the last bit instead of six digits.
EXACT = bool(os.environ.get("EXACT"))
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value) if EXACT else f"{value:.6g}"
    return repr(value)


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(r[i]) for i in order) for r in rows)


def check(spark, con, folder: str, name: str) -> str | None:
    """``None`` when both sides agree, else what differs."""
    df = entry.queries()[name](spark, folder)
    ours = rows_of(df.collect(), df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if ours else "no rows and no twin"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows_of(result.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    odd = [
        f"{f.name}: {f.dataType.simpleString()} / {kinds[f.name]}"
        for f in df.schema
        if TYPES.get(f.dataType.simpleString()) != kinds[f.name]
    ]
    if odd:
        return "types " + "; ".join(odd)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)} rows"
    if not ours:
        return "both sides are empty"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"row differs:\n  {a}\n  {b}"
    return None


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = local_session(int(os.environ.get("CORES", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    names = sys.argv[2:] or list(entry.queries())
    failed = 0
    for name in names:
        started = time.monotonic()
        try:
            problem = check(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        twin = "" if name in entry.oracle_sql() else " (rows only)"
        print(f"{'FAIL' if problem else 'ok'} {name}{twin} {time.monotonic() - started:.1f}s" + (f" {problem}" if problem else ""), flush=True)
        failed += bool(problem)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
