"""Compare registered queries with their SQL on the same parquet files.

Usage: python tests/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple((type(r[i]).__name__, canonical(r[i])) if not isinstance(r[i], (list, tuple)) else canonical(r[i]) for i in order)
        for r in rows
    )


# SQL type of each Spark type that a compared column may have.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def type_problems(df, con, sql):
    expected = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    actual = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    return {c: (actual.get(c), t) for c, t in expected.items() if actual.get(c) != t}


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder, fn, sql):
    """Empty string when equal, else what differs."""
    df = fn(spark, folder)
    columns, actual = as_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if actual else "no rows"
    problems = type_problems(df, con, sql)
    if problems:
        return f"types {problems}"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_columns, expected = as_rows(names, result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} / {expected_columns}"
    if actual == expected:
        return "" if actual else "no rows"
    only_spark, only_sql = actual - expected, expected - actual
    return (f"rows {sum(actual.values())} / {sum(expected.values())}; spark only {list(only_spark)[:2]}; "
            f"sql only {list(only_sql)[:2]}")


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--times", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = connect(args.sf), contract.queries(), contract.oracle_sql()
    bad = 0
    for name in args.names or queries:
        start = time.time()
        try:
            problem = compare(spark, con, args.sf, queries[name], oracle.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        spent = time.time() - start
        if problem:
            bad += 1
            print(f"FAIL {name} ({spent:.1f}s): {problem[:1500]}", flush=True)
        elif args.times or name not in oracle:
            print(f"ok   {name} ({spent:.1f}s){'' if name in oracle else ' rows only'}", flush=True)
    print(f"{len(args.names or queries)} queries, {len(oracle)} with SQL, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
