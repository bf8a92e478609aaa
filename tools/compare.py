"""Compares every query with its SQL twin on one scale factor.

usage: python -m tools.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from shopledger.queries.oracle import ORACLE
from shopledger.queries.registry import QUERIES


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns: list[str], rows) -> list[str]:
    """Rows as text with columns in name order, in row order of that text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and the same multiset of rows."""
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    theirs = canonical(columns, found.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
    return (
        f"rows {len(ours)} vs {len(theirs)}, {len(only_ours)} differ, e.g.\n"
        f"  ours   {sorted(only_ours)[:2]}\n  oracle {sorted(only_theirs)[:2]}"
    )


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    failed = 0
    for name in names:
        start = time.perf_counter()
        problem = differences(QUERIES[name](spark, folder), con, ORACLE[name])
        failed += problem is not None
        print(f"{name}: {problem or 'equal'} ({time.perf_counter() - start:.1f}s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
