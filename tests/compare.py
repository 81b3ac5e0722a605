"""Runs queries in Spark and their SQL in DuckDB and compares all rows.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB type
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(rows: list, names: list[str], order: list[str]) -> list[tuple]:
    index = [names.index(c) for c in order]
    out = [tuple(plain(r[i]) for i in index) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    ours = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    for name, kind in df.dtypes:
        if TYPES.get(kind) != types[name]:
            problems.append(f"type of {name}: {kind} / {types[name]}")
    order = sorted(names)
    a, b = rows_of(ours, df.columns, order), rows_of(theirs, names, order)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} / {len(b)}")
    if a != b:
        only_a, only_b = set(a) - set(b), set(b) - set(a)
        problems.append(f"values differ: {len(only_a)} / {len(only_b)}")
        for x, y in zip(sorted(only_a, key=str)[:3], sorted(only_b, key=str)[:3]):
            problems.append(str([(c, p, q) for c, p, q in zip(order, x, y) if p != q]))
    return problems


def main() -> None:
    import __spark_entry__ as e

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = e.queries(), e.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = differences(build(spark, folder), con, oracles[name])
            else:
                problems = [] if build(spark, folder).count() >= 0 else ["no count"]
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("     ", p)
    print("failed:", bad)


if __name__ == "__main__":
    main()
