"""Runs registered queries and their SQL side by side: ``python -m voltmark_checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from voltmark_checks.oracles import ORACLES
from voltmark_checks.queries import QUERIES
from voltmark import build_session

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def differences(spark, con, sf_dir: str, name: str) -> tuple[int, str | None]:
    """Rows returned, and what differs from the SQL result, exact to the last bit, if anything."""
    result = QUERIES[name](spark, sf_dir)
    columns, rows = _rows(result.columns, [tuple(r) for r in result.collect()])
    answer = con.execute(ORACLES[name])
    expected_columns, expected = _rows([d[0] for d in answer.description], answer.fetchall())
    if columns != expected_columns:
        return len(rows), f"columns {columns} but SQL has {expected_columns}"
    if len(rows) != len(expected):
        return len(rows), f"{len(rows)} rows but SQL has {len(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected, strict=True) if repr(a) != repr(b)]
    return len(rows), f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[*]", {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in args[1:] or QUERIES:
        start = time.time()
        try:
            count, problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            count, problem = 0, f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        verdict = "FAIL" if problem else "ok"
        print(f"{verdict:4} {name:36} {count:7} rows {time.time() - start:6.2f} s  {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
