"""Collects the queries and their SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name. Without SQL only its rows are checked."""
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column: str | Column, name: str | None = None, digits: int = 6) -> Column:
    """A double in the precision both engines agree on; adding zero avoids -0.0."""
    source = F.col(column) if isinstance(column, str) else column
    return (F.round(source, digits) + F.lit(0.0)).alias(name or column)
