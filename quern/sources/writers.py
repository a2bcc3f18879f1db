"""Writing tables: partition folders, buckets, codecs, file counts, save modes, dump and restore."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.joins import salt_pair
from quern.operators.skew import GROUP_LIMIT, parts_for
from quern.session import new_folder

# The four save modes.
MODES = ("overwrite", "append", "ignore", "errorifexists")


def write(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Save under one of the four modes."""
    mode = mode.lower()
    if mode == "error":
        mode = "errorifexists"
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    df.write.format(fmt).mode(mode).save(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> DataFrame:
    """Write `key=value/` folders and read them back with the frame's own types.

    The rebalance hint gathers each folder's rows so files are few, and lets AQE cut a folder that holds a
    large share of all rows into several tasks and files. A folder name cannot tell an empty text from null, so empty
    text in a key is an error.
    """
    texts = [f.name for f in df.schema if f.name in by and isinstance(f.dataType, T.StringType)]
    checked = df
    for name in texts:
        bad = F.raise_error(F.lit(f"{name} is empty text, which a folder name cannot hold"))
        checked = checked.withColumn(name, F.when(F.col(name) == "", bad.cast("string")).otherwise(F.col(name)))
    checked.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)
    return read_partitioned(df.sparkSession, path, df.schema)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a folder tree with given types; without them text keys such as 007 would come back as numbers. A tree without
    rows gives an empty frame."""
    every = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    return spark.read.schema(every).parquet(path).select(*[F.col(f"`{c}`") for c in schema.names])


def write_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    keys: Sequence[str],
    sort_by: Sequence[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Hash rows into buckets, sorted inside each, so tables bucketed alike join without a shuffle.

    Rows are sent to their bucket first: one file per bucket instead of one per task and bucket.
    """
    target = path or new_folder(df.sparkSession, table)
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .option("path", target)
        .bucketBy(buckets, *keys)
        .sortBy(*(sort_by or keys))
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def write_bucketed_pair(
    fact: DataFrame, dim: DataFrame, key: str, row_key: Sequence[str], limit: int = GROUP_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """Two tables bucketed alike on (key, salt), to be joined on both without a shuffle.

    The number of buckets follows the fact's rows. AQE cannot split a bucket that is read in place, so fact keys over
    the limit get several salts, and their dimension rows one copy per salt. All other keys have salt 0.
    """
    buckets = parts_for(fact, limit, 4)
    pair = salt_pair(fact, dim, [key], row_key, None, limit)
    run = uuid.uuid4().hex
    return tuple(
        write_bucketed(side, f"bucketed_{name}_{run}", buckets, [key, "__salt"])
        for name, side in zip(("fact", "dim"), pair)
    )


def write_compact(
    df: DataFrame, path: str, files: int, codec: str = "snappy", spread: Column | None = None
) -> DataFrame:
    """Write a chosen number of files with a chosen codec.

    The rows are hashed over the files by `spread` (default: all columns), so no single task writes everything
    and a retried task sends each row to the same file again.
    """
    spread = F.xxhash64(*df.columns) if spread is None else spread
    df.repartition(files, spread).write.mode("overwrite").option("compression", codec).parquet(path)
    return df.sparkSession.read.parquet(path)


def export_all(
    spark: SparkSession, path: str, db: str | None = None, only: Sequence[str] | None = None
) -> list[str]:
    """Dump every table and view of a database (or those named) to Parquet, one folder each, views apart from tables."""
    names = []
    for table in spark.catalog.listTables(db):
        if only is not None and table.name not in only:
            continue
        space = "view" if table.isTemporary else "table"
        full = table.name if table.isTemporary or not db else f"{db}.{table.name}"
        spark.table(full).write.mode("overwrite").parquet(f"{path}/{space}/{table.name}")
        names.append((space, table.name))
    spark.createDataFrame(names, "space string, name string").coalesce(1).write.mode("overwrite").json(f"{path}/_tables")
    return sorted(name for _, name in names)


def import_all(spark: SparkSession, path: str) -> list[str]:
    """Restore what `export_all` wrote as views over the dumped files. Where a view hid a table of its name, it does so
    again."""
    rows = spark.read.schema("space string, name string").json(f"{path}/_tables").collect()
    for space, name in sorted(rows):
        spark.read.parquet(f"{path}/{space}/{name}").createOrReplaceTempView(name)
    return sorted(r.name for r in rows)
