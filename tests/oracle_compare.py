"""Runs registered queries next to their DuckDB counterparts and compares the rows.

``python tests/oracle_compare.py [folder] [name prefix ...]``"""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return Counter(tuple(plain(row[at]) for at in order) for row in rows)


def difference(spark, connection, folder: str, query, sql: str) -> str | None:
    """None where both sides agree, else what differs."""
    frame = query(spark, folder)
    result = connection.execute(sql)
    expected_columns = [entry[0] for entry in result.description]
    if sorted(frame.columns) != sorted(expected_columns):
        return f"columns {sorted(frame.columns)} != {sorted(expected_columns)}"
    expected = rows_of(expected_columns, result.fetchall())
    found = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; {sum(extra.values())} extra, "
        f"{sum(missing.values())} missing\n  found    {sorted(extra.items(), key=str)[:3]}\n"
        f"  expected {sorted(missing.items(), key=str)[:3]}"
    )


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, bad = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            if name in oracle:
                problem = difference(spark, connection, folder, query, oracle[name])
            else:
                problem = None if query(spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
