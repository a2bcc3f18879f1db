"""Reading files and named sources into typed DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", str(header).lower())
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(schema).csv(path)


def scan_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """JSON lines, or whole-file JSON with `multiline` (those files cannot be split between tasks)."""
    reader = spark.read.option("multiLine", str(multiline).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet. A known schema saves the job that opens file footers to find it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_where(
    spark: SparkSession, path: str, predicate: Column | str, schema: T.StructType | None = None
) -> DataFrame:
    """Read a partitioned folder tree; a predicate on partition columns opens only matching folders. Without a schema
    the types of the keys are guessed from the folder names."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(predicate)


@dataclass
class Sources:
    """Named sources: (group, table) to a reader function."""

    readers: dict[tuple[str, str], Callable[[SparkSession], DataFrame]] = field(default_factory=dict)

    def declare(self, group: str, table: str, reader: Callable[[SparkSession], DataFrame]) -> Sources:
        self.readers[(group, table)] = reader
        return self

    def declare_parquet(self, group: str, table: str, path: str, schema: T.StructType | None = None) -> Sources:
        return self.declare(group, table, lambda spark: scan_parquet(spark, path, schema))

    def source(self, spark: SparkSession, group: str, table: str) -> DataFrame:
        try:
            reader = self.readers[(group, table)]
        except KeyError:
            known = ", ".join(".".join(k) for k in sorted(self.readers))
            raise LookupError(f"source {group}.{table} is not declared; declared: {known}") from None
        return reader(spark)
