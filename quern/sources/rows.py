"""Small tables given in code, and SQL over named frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows written in code, with a stated schema."""
    return spark.createDataFrame(list(rows), schema)


def seed(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str, name: str) -> DataFrame:
    """A small checked-in table, readable by name as well."""
    frame = inline_rows(spark, rows, schema)
    frame.createOrReplaceTempView(name)
    return frame


def sql(spark: SparkSession, query: str, views: Mapping[str, DataFrame], **args) -> DataFrame:
    """Run SQL over frames: `{name}` in the text stands for a frame, `:name` for a parameter."""
    return spark.sql(query, args=args or None, **views)


def add_row(spark: SparkSession, path: str, schema: T.StructType | str, row: tuple) -> None:
    """Append one row to a small log table."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def start_log(spark: SparkSession, path: str, schema: T.StructType | str) -> None:
    """An empty log table, unless there is one."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def logged_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of a log table; none while nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
