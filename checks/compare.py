"""Run registered queries on Spark and in the checking engine and compare whole results.

    python -m checks.compare sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    return value


def as_multiset(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> dict:
    """Row counts, schema and exact values of one query on both engines."""
    started = time.time()
    df = queries()[name](spark, sf_dir)
    ours = [tuple(row) for row in df.collect()]
    seconds = time.time() - started
    cursor = connection.execute(oracle_sql()[name])
    theirs_columns = [d[0] for d in cursor.description]
    theirs_types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    a, b = as_multiset(df.columns, ours), as_multiset(theirs_columns, theirs)
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = {n: kinds.get(t, t) for n, t in df.dtypes}
    return {
        "name": name, "rows": len(ours), "oracle_rows": len(theirs), "seconds": round(seconds, 2),
        "columns": sorted(df.columns) == sorted(theirs_columns), "types": types == theirs_types, "values": a == b,
        "type_difference": {n: (types.get(n), theirs_types.get(n)) for n in types if types.get(n) != theirs_types.get(n)},
        "plan": df._jdf.queryExecution().executedPlan().toString(),
        "only_ours": list((a - b).elements())[:3], "only_oracle": list((b - a).elements())[:3],
    }


def main(argv: list[str]) -> int:
    from ledgerloom import build_session

    sf_dir = f"/root/testdata/{argv[0]}"
    spark = build_session("compare", "local[8]", 8, {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in argv[1:] or queries():
        try:
            r = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            failed += 1
            print(f"FAIL {name}: {str(error)[:400]}", flush=True)
            continue
        good = r["columns"] and r["types"] and r["values"]
        failed += not good
        print("ok  " if good else "FAIL", name, r["rows"], r["oracle_rows"], r["seconds"], flush=True)
        if not good:
            print("   ", {k: r[k] for k in ("columns", "types", "type_difference", "only_ours", "only_oracle")})
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
