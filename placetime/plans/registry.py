"""Names of all registered queries, their functions and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree."""
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def r6(column: Column | str, scale: float = 1.0, digits: int = 6) -> Column:
    """Rounded result: both engines add doubles in their own order."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column / scale, digits) if scale != 1.0 else F.round(column, digits)
