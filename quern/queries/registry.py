"""Registered queries, each next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, and dates as text, so that rows compare alike in any client."""
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string").alias(field.name)
        out.append(col)
    return df.select(*out)
