"""Run every query next to its SQL and compare the rows.

    python -m parity.compare FOLDER [QUERY ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    relation = connection.execute(sql)
    names = [column[0] for column in relation.description]
    expected_rows = relation.fetchall()
    found_rows = spark_df.collect()
    found, expected = rows_of(spark_df.columns, found_rows), rows_of(names, expected_rows)
    problems = []
    if sorted(spark_df.columns) != sorted(names):
        problems.append(f"columns {sorted(spark_df.columns)} but expected {sorted(names)}")
    if found != expected:
        problems.append(f"{len(found_rows)} rows but expected {len(expected_rows)}")
        problems += [f"only here: {row}" for row in list((found - expected).elements())[:3]]
        problems += [f"missing: {row}" for row in list((expected - found).elements())[:3]]
    return problems


def main(folder: str, *only: str) -> int:
    from parity.oracle import ORACLE
    from parity.queries import QUERIES
    from vaportrail.session import local_session

    spark = local_session("parity", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in only or QUERIES:
        start = time.time()
        result = QUERIES[name](spark, folder)
        problems = differences(result, connection, ORACLE[name])
        failed += bool(problems)
        rows = sum(1 for _ in problems)
        print(f"{'FAIL' if rows else 'ok':5}{name:26}{time.time() - start:6.1f} s", flush=True)
        for problem in problems:
            print("     ", problem)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
