"""Compare every query with its SQL: row count, columns and values.

Usage: python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from payments_lake.sources.bridge import TABLES
from verification.oracle import ORACLE
from verification.queries import QUERIES


def _plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4)
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(_plain(row[i]) for i in order) for row in rows),
    )


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """Empty text when both sides agree, otherwise what differs."""
    frame = QUERIES[name](spark, sf_dir)
    columns, actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in ORACLE:
        return ""
    started = time.monotonic()
    result = con.execute(ORACLE[name])
    wanted_columns, wanted = rows_of([d[0] for d in result.description], result.fetchall())
    print(f"  sql {time.monotonic() - started:.1f}s of", end=" ")
    if columns != wanted_columns:
        return f"columns {columns} <> {wanted_columns}"
    if actual == wanted:
        return ""
    only, lack = actual - wanted, wanted - actual
    return (
        f"rows {sum(actual.values())} <> {sum(wanted.values())}; "
        f"only here {list(only)[:3]}; only in SQL {list(lack)[:3]}"
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    con = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.monotonic()
        try:
            difference = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(difference)
        kind = "sql" if name in ORACLE else "rows"
        print(f"{name} [{kind}] {time.monotonic() - started:.1f}s {difference or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
