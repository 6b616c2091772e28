"""Compare queries with their oracles: `python -m spendmill.verify.compare SF_DIR [NAME_PART ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return names, result.fetchall()


def normal(rows: list, names: list[str]) -> list[tuple]:
    """Rows with columns in name order, sorted as text; NaN is kept apart from null."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_rows: DataFrame, sf_dir: str, sql: str) -> list[str]:
    """Empty when column names, row count, value types and values agree."""
    names, expected = oracle_rows(sf_dir, sql)
    got = [tuple(row) for row in spark_rows.collect()]
    if sorted(names) != sorted(spark_rows.columns):
        return [f"columns: {sorted(spark_rows.columns)} instead of {sorted(names)}"]
    if len(got) != len(expected):
        return [f"rows: {len(got)} instead of {len(expected)}"]
    left, right = normal(got, spark_rows.columns), normal(expected, names)
    wrong = [(a, b) for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return [f"{len(wrong)} rows differ, first: {wrong[0][0]} instead of {wrong[0][1]}"] if wrong else []


def main() -> int:
    from spendmill.session import build_session
    from spendmill.verify.registry import oracle_sql, queries

    sf_dir, *parts = sys.argv[1:]
    spark = build_session(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8"
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles, bad = oracle_sql(), 0
    for name, query in queries().items():
        if parts and not any(part in name for part in parts):
            continue
        began = time.time()
        try:
            rows = query(spark, sf_dir)
            count = f"{rows.count()} rows"
            found = differences(rows, sf_dir, oracles[name]) if name in oracles else []
        except Exception as error:  # noqa: BLE001 - one failing query must not hide the others
            count, found = "", [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - began:6.1f}s {name} {count} {'; '.join(found)}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
