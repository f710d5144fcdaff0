"""Registration of queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles whose sums depend on the order of addition are compared to a fixed precision."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column)).alias(f"{column}_us")
