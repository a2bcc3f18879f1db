"""Building tables: views, full builds, incremental loads, gated and audited writes."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.quality import verdict
from quern.operators.skew import null_safe, parts_for
from quern.operators.windows import latest_per_key
from quern.plans import versions
from quern.plans.versions import enforce
from quern.session import cut_lineage, new_folder
from quern.sources.rows import add_row, logged_rows, start_log
from quern.sources.writers import read_partitioned


def build_view(df: DataFrame, name: str) -> DataFrame:
    """A stored query, computed again on every read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def build_table(df: DataFrame, path: str) -> DataFrame:
    """A stored result."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_inline(fn: Callable[..., DataFrame], *inputs: DataFrame) -> DataFrame:
    """A step that is never stored: it becomes part of the query that uses it."""
    return fn(*inputs)


# Incremental loads, as functions of the target's and the batch's rows


def new_rows(batch: DataFrame, target: DataFrame, ts_col: str, newest: str | None = None) -> DataFrame:
    """Batch rows strictly newer than the newest target row; all of them while the target is empty.

    The bound (`newest`, if it is known, as text) is fetched first and filtered as a literal, so it reaches the batch's
    file scan.
    """
    if newest is None:
        newest = target.agg(F.max(ts_col)).first()[0]
    if newest is None:
        return batch
    return batch.where(F.col(ts_col) > F.lit(newest).cast(batch.schema[ts_col].dataType))


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, keys not looked at."""
    return target.unionByName(batch)


def delete_insert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], target_predicate: Column | str | None = None
) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch as it is, repeated keys included.

    With a predicate only matching target rows are compared; the others stay even if the batch has their key.
    """
    batch_keys = batch.select(*keys).distinct()
    if target_predicate is None:
        kept = target.join(batch_keys, list(keys), "left_anti")
    else:
        inside = F.expr(target_predicate) if isinstance(target_predicate, str) else target_predicate
        inside = F.coalesce(inside, F.lit(False))
        kept = (
            target.where(inside).join(batch_keys, list(keys), "left_anti").unionByName(target.where(~inside))
        )
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """An error if two rows have the same key; rows with a null in the key are not compared."""
    repeated = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    found = repeated.first()
    if found:
        raise ValueError(f"a key is repeated: {found.asDict()}")


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    target_predicate: Column | str | None = None,
) -> DataFrame:
    """Update matched keys, insert the others, keep target rows the batch does not mention.

    With `order` the newest row of a repeated batch key wins; without it a repeated key is an error. Rows with a null
    key match nothing and are inserted.
    """
    if order:
        keyless = F.lit(False)
        for key in keys:
            keyless = keyless | F.col(key).isNull()
        batch = latest_per_key(batch.where(~keyless), keys, order).unionByName(batch.where(keyless))
    else:
        require_unique(batch, keys)
    return delete_insert(target, batch, keys, target_predicate)


# Tables that loads change in place


def replace_parts(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Put the rows in place of the partitions that they fall into; the other partitions are neither read nor written."""
    rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def merge_window(
    path: str, schema: T.StructType, batch: DataFrame, keys: Sequence[str], by: Sequence[str], window: Column | str,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Merge into a table partitioned by the columns `by`, reading and replacing only the partitions inside `window`, a
    predicate on these columns. Batch rows of other partitions are added to them, even where their key exists there.

    A partition that loses all its rows, since they moved to another one, is left empty. Returns the table. One load at a
    time; run again after a lost driver, it does what is left to do for rows inside the window.
    """
    spark = batch.sparkSession
    inside = F.coalesce(F.expr(window) if isinstance(window, str) else window, F.lit(False))
    former = read_partitioned(spark, path, schema).where(inside)
    rows = cut_lineage(merge(former, batch.select(*schema.names), keys, order))
    # One row per partition of the window.
    place = F.min("_metadata.file_path").alias("file")
    held = spark.read.schema(schema).parquet(path).where(inside).groupBy(*by).agg(place)
    left = rows.select(*by).distinct()
    emptied = [r.file for r in held.join(left, null_safe(held, left, by), "left_anti").collect()]
    replace_parts(rows.where(inside), path, by)
    rows.where(~inside).write.mode("append").partitionBy(*by).parquet(path)
    none = spark.createDataFrame([], T.StructType([f for f in schema if f.name not in by]))
    for file in emptied:
        none.write.mode("overwrite").parquet(unquote(file.rpartition("/")[0]))
    return read_partitioned(spark, path, schema)


#: Rows that a key part holds, on average, when a table is first written.
PART_ROWS = 5_000_000
PART, LOAD = "__part", "__load"
LOADS = (
    "load bigint, loaded_at timestamp_ntz, strategy string, row_count bigint, watermark string, keys array<string>, parts int, "
    "folder string, schema_json string"
)


def loads(spark: SparkSession, root: str) -> DataFrame:
    """One row per load of a table: what was done, the newest value of its watermark column, and how the table is laid out."""
    return logged_rows(spark, f"{root}/loads", LOADS)


def last_load(spark: SparkSession, root: str) -> Row | None:
    return loads(spark, root).orderBy(F.desc("load")).first()


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The rows of a table that `build_incremental` or `load_by_key` keeps."""
    past = last_load(spark, root)
    if past is None:
        raise LookupError(f"{root} has not been loaded")
    return _rows(spark, root, past)


def _rows(spark: SparkSession, root: str, past: Row, touched: Sequence[int] | None = None) -> DataFrame:
    """A table's rows; with `touched` only those of these key parts."""
    schema, column = T.StructType.fromJson(json.loads(past.schema_json)), PART if past.keys else LOAD
    rows = spark.read.schema(T.StructType(schema.fields).add(column, T.LongType())).parquet(f"{root}/{past.folder}")
    if not past.keys:
        # Rows of a load that did not finish are not in the table.
        rows = rows.where(F.col(LOAD) <= past.load)
    elif touched is not None:
        rows = rows.where(F.col(PART).isin(list(touched)))
    return rows.select(*schema.names)


def _counted(rows: DataFrame, ts_col: str | None) -> tuple[DataFrame, Observation]:
    """The rows, counted and with the newest watermark while they are written."""
    seen = Observation(f"load-{uuid.uuid4().hex}")
    newest = (F.max(ts_col).cast("string") if ts_col else F.lit(None).cast("string")).alias("newest")
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), newest), seen


def load_by_key(
    root: str,
    batch: DataFrame,
    keys: Sequence[str],
    combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    now: dt.datetime | None = None,
    ts_col: str | None = None,
    strategy: str = "merge",
    afresh: bool = False,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Combine a batch with the target's rows in the key parts that the batch touches, and replace these parts.

    A key part is a partition of the table, numbered by a hash of the key, so a key is in the same part at every load. How
    many there are is fixed by the first load. A table that has no key parts, or parts of another key, is written anew with
    them once; so it is with `afresh`, which leaves out the former rows. Loading the same batch again changes nothing. Returns the table.
    """
    spark = batch.sparkSession
    start_log(spark, f"{root}/loads", LOADS)
    past = last_load(spark, root)
    number = past.load + 1 if past else 0
    if past and not afresh and past.keys == list(keys):
        n, folder = past.parts, past.folder
        enforce(batch, T.StructType.fromJson(json.loads(past.schema_json)))
        touched = [r[0] for r in batch.select(_key_part(keys, n)).distinct().collect()]
        rows = combine(_rows(spark, root, past, touched), batch) if combine else batch
    else:
        rows = combine(_rows(spark, root, past), batch) if past and combine and not afresh else batch
        n, folder = parts_for(rows, part_rows, 8), f"data-{number}"
    rows, seen = _counted(rows, ts_col)
    replace_parts(rows.withColumn(PART, _key_part(keys, n)), f"{root}/{folder}", [PART])
    newest = max(filter(None, [seen.get["newest"], past.watermark if past and not afresh else None]), default=None)
    schema = batch.schema.json() if not past or afresh else past.schema_json
    return _rows(spark, root, _log(spark, root, (number, now, strategy, seen.get["rows"], newest, list(keys), n, folder, schema)))


def _key_part(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("bigint")


def _log(spark: SparkSession, root: str, row: tuple) -> Row:
    """Add a load to the log, and return it by its columns' names."""
    at = row[1] or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    full = (row[0], at, *row[2:])
    add_row(spark, f"{root}/loads", LOADS, full)
    return Row(*[column.split()[0] for column in LOADS.split(", ")])(*full)


def _add(root: str, batch: DataFrame, past: Row | None, now: dt.datetime | None, ts_col: str | None, strategy: str) -> DataFrame:
    """Write the batch as the partition of its load, which readers see once the load is in the log. Returns the table."""
    spark, number = batch.sparkSession, past.load + 1 if past else 0
    adds = strategy == "append" and past is not None
    schema = T.StructType.fromJson(json.loads(past.schema_json)) if adds else batch.schema
    if adds:
        enforce(batch, schema)
    rows, seen = _counted(batch.select(*schema.names), ts_col)
    folder = past.folder if adds else f"data-{number}"
    rows.write.mode("overwrite").parquet(f"{root}/{folder}/{LOAD}={number}")
    newest = seen.get["newest"] or (past.watermark if adds else None)
    return _rows(spark, root, _log(spark, root, (number, now, strategy, seen.get["rows"], newest, None, None, folder, schema.json())))


def build_incremental(
    root: str,
    batch: DataFrame,
    ts_col: str | None = None,
    keys: Sequence[str] | None = None,
    strategy: str = "append",
    order: Sequence[str] | None = None,
    full_refresh: bool = False,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Load a batch into a table and return it.

    First run and full refresh write the whole batch, laid out by key if the strategy needs keys. Later runs take the rows
    past the watermark (`ts_col`) and append, merge or delete-and-insert them; the last two read and replace only the key
    parts that the batch touches. A full refresh goes to a folder of its own, which readers see when it is complete.
    """
    spark = batch.sparkSession
    if strategy not in ("append", "merge", "delete+insert"):
        raise ValueError(f"strategy {strategy!r} is not append, merge or delete+insert")
    start_log(spark, f"{root}/loads", LOADS)
    past = last_load(spark, root)
    if past is None or full_refresh:
        if keys:
            return load_by_key(root, batch, keys, None, now, ts_col, "full", afresh=True)
        return _add(root, batch, past, now, ts_col, "full")
    fresh = new_rows(batch, _rows(spark, root, past), ts_col, past.watermark) if ts_col else batch
    if strategy == "merge":
        return load_by_key(root, fresh, keys, lambda old, new: merge(old, new, keys, order), now, ts_col)
    if strategy == "delete+insert":
        return load_by_key(root, fresh, keys, lambda old, new: delete_insert(old, new, keys), now, ts_col, strategy)
    if past.keys:
        return load_by_key(root, fresh, past.keys, append, now, ts_col, strategy)
    return _add(root, fresh, past, now, ts_col, strategy)


# Gates


Checks = Mapping[str, Callable[[DataFrame], DataFrame]]


def judge(df: DataFrame, checks: Mapping[str, tuple], model: str = "model") -> DataFrame:
    """Verdict rows for checks {name: (fn, severity[, warn_if[, error_if]])}."""
    out = None
    for name, (fn, *rule) in checks.items():
        row = verdict(fn(df), *rule).select(F.lit(model).alias("model"), F.lit(name).alias("check"), "failures", "status")
        out = row if out is None else out.unionByName(row)
    return out


def _publish_if_good(df: DataFrame, checks: Mapping[str, tuple], publish_fn: Callable[[], object]) -> DataFrame:
    verdicts = judge(df, checks)
    rows = verdicts.collect()
    if not any(r.status == "error" for r in rows):
        publish_fn()
    return df.sparkSession.createDataFrame(rows, verdicts.schema)


def gated_publish(df: DataFrame, checks: Mapping[str, tuple], write_fn: Callable[[DataFrame], object]) -> DataFrame:
    """Write only if no check ends in an error; warnings let it pass. Returns the verdicts.

    The rows are staged first, so what is written is what was checked, and the frame is evaluated once.
    """
    staged = build_table(df, new_folder(df.sparkSession, "gate"))
    return _publish_if_good(staged, checks, lambda: write_fn(staged))


def publish(df: DataFrame, checks: Mapping[str, tuple], root: str, now: dt.datetime | None = None) -> DataFrame:
    """Build aside, check what was built, then switch readers to it.

    The rows are written once, where no reader looks yet. They become the next version only if no check ends in an
    error; readers of `versions.as_of_version(spark, root)` see the former one until then.
    """
    spark, entry = df.sparkSession, versions.write_next(df, root, "overwrite", now)
    staged = versions.partitions(spark, root, entry).drop(versions.VERSION)
    return _publish_if_good(staged, checks, lambda: versions.record(spark, root, entry))


# Audit


def audited(
    name: str, write_fn: Callable[[], DataFrame], audit_path: str, run_id: str, now: Callable[[], dt.datetime]
) -> DataFrame:
    """Run a build and append what happened to the audit table: name, rows, status, start, end."""
    spark = SparkSession.getActiveSession()
    started = now()
    schema = (
        "run_id string, name string, row_count bigint, status string, started_at timestamp_ntz, ended_at timestamp_ntz"
    )

    def log(rows: int | None, status: str) -> None:
        add_row(spark, audit_path, schema, (run_id, name, rows, status, started, now()))

    try:
        built = write_fn()
        rows = built.count()
    except Exception:
        log(None, "error")
        raise
    log(rows, "success")
    return built


def schema_name(custom: str | None, default: str, env: str) -> str:
    """Target schema: the default without a custom one, the custom one in production, both joined elsewhere."""
    if not custom:
        return default
    return custom.strip() if env == "prod" else f"{default}_{custom.strip()}"


def register_versions(spark: SparkSession, name: str, frames: Mapping[int, DataFrame], latest: int) -> DataFrame:
    """Views `name_v1`, `name_v2`, … and `name` for the latest."""
    for number, frame in frames.items():
        frame.createOrReplaceTempView(f"{name}_v{number}")
    frames[latest].createOrReplaceTempView(name)
    return spark.table(name)
