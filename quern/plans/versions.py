"""Versioned tables: numbered commits, time travel, change feed.

The rows of a commit are one partition of a plain Parquet table, and a small table beside it has a row per commit. An append
adds its partition to what was there; an overwrite starts anew. So a version is the partitions from its last overwrite
(`base`) up to its own number, which is a filter on the partition column. A partition without a history row is a commit that
did not finish: no reader sees it, and the next commit writes over it. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.quality import contract
from quern.operators.skew import null_safe
from quern.sources.rows import add_row, logged_rows, start_log

HISTORY = (
    "version bigint, base bigint, committed_at timestamp_ntz, operation string, row_count bigint, schema_json string, "
    "writer string, batch_id bigint"
)
VERSION = "__version"  # the partition column

# Column names of the change feed.
CHANGE_TYPE, CHANGE_VERSION, CHANGE_TIME = "_change_type", "_commit_version", "_commit_timestamp"


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per commit; none for a table that is not there."""
    return logged_rows(spark, f"{root}/history", HISTORY)


def entry_of(spark: SparkSession, root: str, version: int | None = None) -> Row | None:
    """The history row of a version, of the newest without one; None if there is none."""
    known = history(spark, root)
    if version is not None:
        known = known.where(F.col("version") == version)
    return known.orderBy(F.desc("version")).first()


def enforce(df: DataFrame, schema: T.StructType, merge_schema: bool = False) -> T.StructType:
    """The schema after writing `df` to a table of `schema`; an error if its columns do not fit.

    With `merge_schema` the frame may lack columns (null then) and bring new ones (null in older rows). A changed type
    is always refused.
    """
    allowed = {"missing", "undeclared"} if merge_schema else set()
    bad = [b for b in contract(df, schema).collect() if b.problem not in allowed]
    if bad:
        raise ValueError("schema not accepted: " + "; ".join(f"{b.column}: {b.problem}" for b in bad))
    return T.StructType(schema.fields + [f for f in df.schema if f.name not in schema.names])


def write_next(
    df: DataFrame, root: str, mode: str = "append", now: dt.datetime | None = None, merge_schema: bool = False,
    writer: str | None = None, batch_id: int | None = None, by: Sequence[str] = (),
) -> Row:
    """Write the rows of the next version, which no reader sees until its history row, returned here, is recorded.

    `by` divides the version's folder further, for readers that want some of its rows.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode!r} is neither append nor overwrite")
    spark = df.sparkSession
    start_log(spark, f"{root}/history", HISTORY)
    past = entry_of(spark, root)
    at = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if past and at < past.committed_at:
        # A time before the last commit would make reading by time ambiguous.
        if now:
            raise ValueError(f"{now} lies before the last commit, {past.committed_at}")
        at = past.committed_at
    version, schema = past.version + 1 if past else 0, df.schema
    adds = mode == "append" and past is not None
    if adds:
        schema = enforce(df, T.StructType.fromJson(json.loads(past.schema_json)), merge_schema)
    counted = Observation(f"commit-{version}")
    writer_of = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    (writer_of.partitionBy(*by) if by else writer_of).parquet(f"{root}/data/{VERSION}={version}")
    values = (version, past.base if adds else version, at, mode, counted.get["rows"], schema.json(), writer, batch_id)
    return Row(*spark.createDataFrame([], HISTORY).columns)(*values)


def record(spark: SparkSession, root: str, entry: Row) -> int:
    """Add the history row, which makes a version visible."""
    add_row(spark, f"{root}/history", HISTORY, tuple(entry))
    return entry.version


def commit(df: DataFrame, root: str, *args, **options) -> int:
    """Write the rows as the next version and return its number; the arguments are those of `write_next`."""
    return record(df.sparkSession, root, write_next(df, root, *args, **options))


def partitions(spark: SparkSession, root: str, entry: Row, first: int | None = None) -> DataFrame:
    """Rows of the partitions from `first` (the version's base) to a version, with their number."""
    schema = T.StructType.fromJson(json.loads(entry.schema_json)).add(VERSION, T.LongType())
    rows = spark.read.schema(schema).parquet(f"{root}/data").select(*schema.names)
    return rows.where(F.col(VERSION).between(entry.base if first is None else first, entry.version))


def as_of_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Rows as of a version; of the latest without one."""
    entry = entry_of(spark, root, version)
    if entry is None:
        raise LookupError(f"{root} has no versions" if version is None else f"{root} has no version {version}")
    return partitions(spark, root, entry).drop(VERSION)


def as_of_time(spark: SparkSession, root: str, at: dt.datetime) -> DataFrame:
    """Rows as of the last commit at or before a time."""
    known = history(spark, root).where(F.col("committed_at") <= F.lit(at).cast("timestamp_ntz"))
    number = known.agg(F.max("version")).first()[0]
    if number is None:
        raise LookupError(f"{root} has no version at {at}")
    return as_of_version(spark, root, number)


def compare(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Row changes between two states that are unique on `key`, by one null-safe full join."""
    cols = after.columns
    before = before.select(*[F.col(c) if c in before.columns else F.lit(None).alias(c) for c in cols])
    b = before.select(F.struct(*cols).alias("b"), *[F.col(k).alias(f"__b_{i}") for i, k in enumerate(key)])
    a = after.select(F.struct(*cols).alias("a"), *[F.col(k).alias(f"__a_{i}") for i, k in enumerate(key)])
    names = range(len(key))
    pairs = b.join(a, null_safe(b, a, [f"__b_{i}" for i in names], [f"__a_{i}" for i in names]), "full")

    def change(kind, row):
        return F.struct(F.lit(kind).alias(CHANGE_TYPE), F.col(row).alias("row"))

    changes = (
        F.when(F.col("b").isNull(), F.array(change("insert", "a")))
        .when(F.col("a").isNull(), F.array(change("delete", "b")))
        .when(
            ~F.col("a").eqNullSafe(F.col("b")),
            F.array(change("update_preimage", "b"), change("update_postimage", "a")),
        )
    )
    # Unchanged rows have a null list, and explode gives no row for it.
    return pairs.select(F.explode(changes).alias("c")).select("c.row.*", f"c.{CHANGE_TYPE}")


def change_feed(spark: SparkSession, root: str, key: list[str], start: int = 0, end: int | None = None) -> DataFrame:
    """Row changes made by the commits start … end, both included. Appends are inserts, read from their own partitions;
    an overwrite is compared with the version before it."""
    asked = history(spark, root).where(F.col("version") >= start)
    asked = sorted((asked if end is None else asked.where(F.col("version") <= end)).collect(), key=lambda r: r.version)
    if not asked or end not in (None, asked[-1].version):
        raise LookupError(f"{root} has no versions from {start} to {end}")
    known = spark.createDataFrame(
        [(e.version, e.committed_at) for e in asked], f"{CHANGE_VERSION} bigint, {CHANGE_TIME} timestamp_ntz"
    )
    out, adding = None, {}
    for e in asked:
        if e.operation == "append" or e.version == 0:
            adding.setdefault(e.schema_json, []).append(e)
            continue
        rows = compare(as_of_version(spark, root, e.version - 1), as_of_version(spark, root, e.version), key)
        rows = rows.withColumn(CHANGE_VERSION, F.lit(e.version).cast("bigint"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    for entries in adding.values():
        rows = partitions(spark, root, entries[-1], entries[0].version)
        rows = rows.where(F.col(VERSION).isin([e.version for e in entries])).withColumn(CHANGE_TYPE, F.lit("insert"))
        rows = rows.withColumnRenamed(VERSION, CHANGE_VERSION)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    cols = [c for c in out.columns if c not in (CHANGE_TYPE, CHANGE_VERSION)]
    return out.join(F.broadcast(known), CHANGE_VERSION).select(*cols, CHANGE_TYPE, CHANGE_VERSION, CHANGE_TIME)


def apply_changes(state: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """Apply the changes of one commit to the state before it."""
    gone = changes.where(F.col(CHANGE_TYPE).isin("delete", "update_preimage")).select(
        *[F.col(k).alias(f"__g_{i}") for i, k in enumerate(key)]
    )
    kept = state.join(gone, null_safe(state, gone, key, [f"__g_{i}" for i in range(len(key))]), "left_anti")
    come = changes.where(F.col(CHANGE_TYPE).isin("insert", "update_postimage")).select(*state.columns)
    return kept.unionByName(come)


def commit_batch(root: str, writer: str, mode: str = "append", now: Callable[[int], dt.datetime] | None = None):
    """A `foreachBatch` function that commits each micro-batch exactly once: a batch whose number this writer (best named by
    its checkpoint folder) has in the history already is skipped."""

    def write(rows: DataFrame, number: int) -> None:
        start_log(rows.sparkSession, f"{root}/history", HISTORY)
        own = history(rows.sparkSession, root).where(F.col("writer") == writer)
        if own.where(F.col("batch_id") >= number).isEmpty():
            commit(rows, root, mode, now(number) if now else None, writer=writer, batch_id=number)

    return write
