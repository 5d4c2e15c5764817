"""Compare registered queries with their SQL in DuckDB: columns, row count and values, regardless of row order.

Usage: python -m tests.oracle_check [folder] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, connection, folder: str, name: str, queries, oracles) -> tuple[int, list[str]]:
    df = queries[name](spark, folder)
    got = [tuple(row) for row in df.collect()]
    if name not in oracles:
        return len(got), []
    result = connection.execute(oracles[name])
    columns = [item[0] for item in result.description]
    want = result.fetchall()
    problems = []
    if sorted(columns) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} instead of {sorted(columns)}")
        return len(got), problems
    if len(got) != len(want):
        problems.append(f"{len(got)} rows instead of {len(want)}")
    left, right = sorted_rows(df.columns, got), sorted_rows(columns, want)
    if left != right:
        a, b = set(map(repr, left)), set(map(repr, right))
        problems.append(f"only in spark {sorted(a - b)[:3]}; only in sql {sorted(b - a)[:3]}")
    return len(got), problems


def main() -> int:
    from requestlens.catalog import ORACLES, QUERIES
    from requestlens.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            rows, problems = differences(spark, connection, folder, name, QUERIES, ORACLES)
        except Exception as error:  # report and go on with the next query
            rows, problems = 0, [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {rows} rows {time.time() - start:.1f}s {'; '.join(problems)}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
