"""Histories of changing rows (slowly changing dimension, type 2).

Every key has one open version at most, and versions of a key do not overlap. Closed versions pass through without
being joined; only open versions meet the current rows, in one full outer join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.plans import versions
from quern.plans.builds import require_unique

# Fixed names of the four columns a history adds, as existing queries on such tables use them.
SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = META = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def _first_versions(cur: DataFrame, key: str, stamp: Column) -> DataFrame:
    """Current rows as open versions starting at `stamp`. A repeated key would open two versions, and is an error."""
    require_unique(cur, [key])
    stamp = stamp.cast("timestamp_ntz")
    row_id = F.md5(F.concat_ws("|", F.col(key).cast("string"), stamp.cast("string")))
    return cur.select(
        *cur.columns,
        row_id.alias(SCD_ID),
        stamp.alias(UPDATED_AT),
        stamp.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def _advance(prev: DataFrame, new: DataFrame, key: str, changed: Column, deleted_at: Column | None) -> DataFrame:
    """Close, keep and add versions. `changed` compares the structs `old` and `new`."""
    cols = new.columns
    closed = prev.where(F.col(VALID_TO).isNotNull())
    old = prev.where(F.col(VALID_TO).isNull()).select(F.struct(*cols).alias("old"), F.col(key).alias("__old_key"))
    cur = new.select(F.struct(*cols).alias("new"), F.col(key).alias("__new_key"))
    both = old.join(cur, F.col("__old_key") == F.col("__new_key"), "full")

    def ended(at: Column) -> Column:
        return F.col("old").withField(VALID_TO, at.cast("timestamp_ntz"))

    gone = F.array(F.col("old")) if deleted_at is None else F.array(ended(deleted_at))
    versions = (
        F.when(F.col("old").isNull(), F.array(F.col("new")))
        .when(F.col("new").isNull(), gone)
        .when(changed, F.array(ended(F.col(f"new.{VALID_FROM}")), F.col("new")))
        .otherwise(F.array(F.col("old")))
    )
    moved = both.select(F.explode(versions).alias("v")).select("v.*")
    return closed.select(*cols).unionByName(moved)


def snapshot_timestamp(
    prev: DataFrame | None,
    cur: DataFrame,
    key: str,
    updated_at: str,
    close_deleted: bool = False,
    run_at: dt.datetime | None = None,
) -> DataFrame:
    """New version when `updated_at` moved forward. Rows whose `updated_at` went back are left as they are
    (`moved_back` lists them). Keys that are gone stay open unless `close_deleted`, which needs `run_at`."""
    if close_deleted and run_at is None:
        raise ValueError("close_deleted needs run_at, the time at which the versions end")
    new = _first_versions(cur, key, F.col(updated_at))
    if prev is None:
        return new
    newer = F.col(f"new.{VALID_FROM}") > F.col(f"old.{VALID_FROM}")
    return _advance(prev, new, key, newer, F.lit(run_at) if close_deleted else None)


def snapshot_check(
    prev: DataFrame | None,
    cur: DataFrame,
    key: str,
    cols: Sequence[str] | str,
    run_at: dt.datetime,
    close_deleted: bool = False,
) -> DataFrame:
    """New version when any of the columns differs (null equals null); versions start at `run_at`. `cols="all"`
    compares every column but the key."""
    new = _first_versions(cur, key, F.lit(run_at))
    if prev is None:
        return new
    names = [c for c in cur.columns if c != key] if cols == "all" else list(cols)
    differs = reduce(lambda a, b: a | b, [~F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in names])
    return _advance(prev, new, key, differs, F.lit(run_at) if close_deleted else None)


#: Folder column of a stored history, in the folder of each run: open versions as of the run, or versions that it closed.
STATE, OPEN, CLOSED = "__state", "open", "closed"


def store_history(
    cur: DataFrame,
    root: str,
    key: str,
    updated_at: str | None = None,
    cols: Sequence[str] | str | None = None,
    run_at: dt.datetime | None = None,
    close_deleted: bool = False,
) -> DataFrame:
    """Bring a stored history up to date, by timestamp (`updated_at`) or by compared `cols`, and return it.

    A run reads the open versions of the run before and writes those that are open now next to those that it closed, as one
    version of a table; what earlier runs closed is neither read nor written again.
    """
    spark = cur.sparkSession
    versions.start_log(spark, f"{root}/history", versions.HISTORY)
    past = versions.entry_of(spark, root)
    prev = None
    if past:
        prev = versions.partitions(spark, root, past, past.version).where(F.col(STATE) == OPEN).drop(STATE, versions.VERSION)
    if updated_at:
        moved = snapshot_timestamp(prev, cur, key, updated_at, close_deleted, run_at)
    else:
        moved = snapshot_check(prev, cur, key, cols, run_at, close_deleted)
    moved = moved.withColumn(STATE, F.when(F.col(VALID_TO).isNull(), F.lit(OPEN)).otherwise(F.lit(CLOSED)))
    versions.commit(moved.hint("rebalance", STATE), root, "append", run_at, by=[STATE])
    return stored_history(spark, root)


def stored_history(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A stored history as of a run, of the last without one: its open versions, and what it and earlier runs closed."""
    entry = versions.entry_of(spark, root, version)
    if entry is None:
        raise LookupError(f"{root} holds no such history")
    now = (F.col(STATE) == CLOSED) | (F.col(versions.VERSION) == entry.version)
    return versions.partitions(spark, root, entry).where(now).drop(STATE, versions.VERSION)


def moved_back(prev: DataFrame, cur: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Current rows older than the open version of their key."""
    starts = current_rows(prev).select(F.col(key).alias("__key"), F.col(VALID_FROM).alias("__from"))
    return cur.join(
        starts, (F.col(key) == F.col("__key")) & (F.col(updated_at) < F.col("__from")), "left_semi"
    )


def current_rows(hist: DataFrame) -> DataFrame:
    """Open versions: one row per key."""
    return hist.where(F.col(VALID_TO).isNull())


def closed_counts(hist: DataFrame) -> DataFrame:
    """How many versions were closed at each time."""
    return (
        hist.where(F.col(VALID_TO).isNotNull())
        .groupBy(F.col(VALID_TO).alias("closed_at"))
        .agg(F.count(F.lit(1)).alias("closed"))
    )
