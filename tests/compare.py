"""Run queries and their SQL on the same tables and compare every value."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sortable(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, repr(value))
    if isinstance(value, (int, float)):
        return (2, f"{float(value):+030.9f}")
    if isinstance(value, (dt.date, dt.datetime)):
        return (3, value.isoformat())
    return (4, str(value))


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: [_sortable(v) for v in row])


def same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return left == right or (math.isnan(left) and math.isnan(right))
    return left == right and type(left) is type(right)


def differences(spark_df, connection, sql: str) -> list[str]:
    """Human-readable differences, empty when both results agree exactly."""
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    expected = _rows(names, relation.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if sorted(names) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} != {sorted(names)}")
        return found
    if len(got) != len(expected):
        found.append(f"rows {len(got)} != {len(expected)}")
    ordered = sorted(names)
    for a, b in zip(got, expected):
        bad = [f"{n}: {x!r} != {y!r}" for n, x, y in zip(ordered, a, b) if not same(x, y)]
        if bad:
            found.append("; ".join(bad))
        if len(found) > 4:
            break
    return found


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            problems = differences(df, connection, oracles[name]) if name in oracles else []
            count = df.count() if not problems else -1
        except Exception as error:  # report and go on
            problems, count = [f"{type(error).__name__}: {str(error)[:1500]}"], -1
        verdict = "ok" if not problems else "DIFFERENT"
        note = "" if name in oracles else " (no SQL)"
        print(f"{verdict:10}{name}{note} rows={count} {time.time() - started:.1f}s", flush=True)
        for problem in problems:
            print("    ", problem[:700], flush=True)


if __name__ == "__main__":
    main()
