"""Runs registered queries and their DuckDB statements side by side.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize()) if value else "0"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_columns, spark_rows, duck_columns, duck_rows) -> str | None:
    """What differs between two results, row order aside; None if nothing does."""
    if sorted(spark_columns) != sorted(duck_columns):
        return f"columns: {sorted(set(spark_columns) ^ set(duck_columns))}"
    if len(spark_rows) != len(duck_rows):
        return f"rows: {len(spark_rows)} against {len(duck_rows)}"
    left, right = _rows(spark_columns, spark_rows), _rows(duck_columns, duck_rows)
    for a, b in zip(left, right):
        if a != b:
            names = sorted(spark_columns)
            return "values: " + "; ".join(
                f"{n}: {x} against {y}" for n, x, y in zip(names, a, b) if x != y
            )
    return None


def check(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[str | None, int]:
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None, len(rows)
    result = con.execute(sql)
    duck_columns = [d[0] for d in result.description]
    return difference(df.columns, rows, duck_columns, result.fetchall()), len(rows)


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    from checks.registry import ORACLE, QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            problem, n = check(spark, con, sf_dir, name, QUERIES[name], ORACLE.get(name))
        except Exception as error:  # report and go on to the next query
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        kind = "sql" if name in ORACLE else "rows only"
        print(f"{'FAIL' if problem else 'ok':4} {name} {n} rows ({kind}) {time.time() - start:.1f}s"
              + (f"\n     {problem[:1500]}" if problem else ""), flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
