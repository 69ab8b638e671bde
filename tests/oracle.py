"""Compare the queries with their SQL: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when the rows agree, else what differs."""
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = rows_of(expected_columns, cursor.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} instead of {sorted(expected_columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]}"
    kinds = [{type(v) for row in rows for v in (row[i],) if v is not None}
             for rows in (actual, expected) for i in range(len(expected_columns))]
    half = len(expected_columns)
    for name, a, e in zip(sorted(expected_columns), kinds[:half], kinds[half:]):
        if a != e:
            return f"column {name} has types {a} instead of {e}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from loamlens.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql, bad = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = function(spark, sf_dir)
            if name in sql:
                problem = compare(df, con, sql[name])
                label = "ok" if problem is None else f"DIFFERS: {problem}"
            else:
                problem, label = None, f"rows only: {len(df.collect())}"
        except Exception as error:
            problem = label = f"FAILED: {type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s  {label}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
