"""Event-time streams. Every function takes and returns a streaming DataFrame, except the runners at the end.

Nothing is gathered on the driver: results go to Parquet through a checkpointed file sink, or to a versioned table by
micro-batch.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quern.functions.expressions import default_to
from quern.operators.joins import time_bucket
from quern.operators.skew import broadcast_if_small, null_safe
from quern.plans import versions
from quern.plans.builds import load_by_key, read_table, replace_parts, require_unique
from quern.session import ROCKSDB, STATE_STORE
from quern.sources.writers import read_partitioned

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
# Fixed values of the risk rules.
DEFAULT_RISK = 0.1
DEFAULT_CATEGORY = "STANDARD"
BLOCK_AMOUNT = 1000.0
BLOCK_RISK = 0.70
REVIEW_AMOUNT = 500.0
BLOCKED, REVIEW, APPROVED = "BLOCKED_CRITICAL", "FLAGGED_REVIEW", "APPROVED"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Files of a folder (or matching a pattern) as a stream, with a stated schema. The number of files per micro-batch is for the caller:
    one keeps batches small, none reads all that has arrived."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a timestamp with time zone; one without is read as session time."""
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        return stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream


def with_lateness(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows older than the newest event time minus the delay may be ignored, and finished state is dropped."""
    return event_time(stream, ts).withWatermark(ts, delay)


def stream_filter(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    predicate: Column | str,
    fmt: str = "parquet",
    files_per_trigger: int | None = 1,
) -> DataFrame:
    return read_stream(spark, path, schema, fmt, files_per_trigger).where(predicate)


def stream_totals(stream: DataFrame, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Running aggregate per key."""
    return stream.groupBy(*by).agg(*aggs)


def tumbling(
    stream: DataFrame, ts: str, size: str, delay: str, by: Sequence[str], aggs: Sequence[Column]
) -> DataFrame:
    """Fixed windows of event time. Tasks aggregate before the shuffle, so a frequent key costs one row per task."""
    return sliding(stream, ts, size, size, delay, by, aggs)


def sliding(
    stream: DataFrame, ts: str, size: str, slide: str, delay: str, by: Sequence[str], aggs: Sequence[Column]
) -> DataFrame:
    """Windows of one size starting every `slide`; a row is in each window that covers it."""
    late = with_lateness(stream, ts, delay)
    window = F.window(ts, size) if size == slide else F.window(ts, size, slide)
    grouped = late.groupBy(window.alias("__window"), *by).agg(*aggs)
    names = [c for c in grouped.columns if c != "__window"]
    return grouped.select(
        F.col("__window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("__window.end").cast("timestamp_ntz").alias("window_end"),
        *names,
    )


def _totals(keys: Sequence[str], sums: Sequence[str], ttl_ms: int | None) -> StatefulProcessor:
    """One value per key: its sums so far. Emits the keys that a micro-batch changes.

    The class is made here, so that it is sent by value: Spark also loads it in a Python process beside the driver, which
    need not find this library. It takes rows, not pandas frames, in which one null turns a batch's whole numbers into
    floating point, and with them the keys that state is found by.
    """
    keys, sums = list(keys), list(sums)

    class Totals(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            schema = T.StructType([T.StructField(f"s{i}", T.LongType()) for i in range(len(sums))])
            self.held = handle.getValueState("totals", schema, ttl_ms)

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            totals = list(self.held.get()) if self.held.exists() else [0] * len(sums)
            for row in rows:
                totals = [t + row[name] for t, name in zip(totals, sums)]
            self.held.update(tuple(totals))
            yield Row(*keys, *sums)(*key, *totals)

        def close(self) -> None:
            pass

    return Totals()


def running_totals(
    stream: DataFrame, keys: Sequence[str], amounts: Mapping[str, Column], ttl_seconds: int | None = None, count: str = "events"
) -> DataFrame:
    """Rows and sums of whole numbers per key in state that may expire, as a stream for update mode: each trigger gives the
    keys that it changes.

    A key without rows for `ttl_seconds` is forgotten and begins at nothing when it comes again; None keeps every key, as
    `stream_totals` does. Amounts are cast to bigint, null counts as 0. Tasks sum each Arrow batch by key before the
    shuffle, so a frequent key sends one row for some thousands of its own. A null key is a key. Run it with `idle=False`, which
    ends with what has arrived and keeps the state where it can be kept; a query started otherwise has to set RocksDB as its
    state store.
    """
    sums = [count, *amounts]
    clash = set(keys) & set(sums)
    if clash or len(set(sums)) < len(sums):
        raise ValueError(f"names are used twice: {sorted(clash) or sums}")
    one = F.lit(1).cast("bigint").alias(count)
    rows = stream.select(*keys, one, *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(n) for n, c in amounts.items()])

    def by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grouped = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate([(n, "sum") for n in sums])
            named = grouped.select([*keys, *[f"{n}_sum" for n in sums]]).rename_columns([*keys, *sums])
            yield from named.to_batches()

    return (
        rows.mapInArrow(by_batch, rows.schema)
        .groupBy(*keys)
        .transformWithState(
            _totals(keys, sums, ttl_seconds * 1000 if ttl_seconds else None), rows.schema, "Update", "ProcessingTime"
        )
    )


def enrich(stream: DataFrame, static: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a fixed table; no state. It is broadcast if it measures small enough."""
    return stream.join(broadcast_if_small(static), key, how)


def join_streams(
    a: DataFrame, b: DataFrame, keys: Sequence[str], t1: str, t2: str, seconds: int, delay: str
) -> DataFrame:
    """Pairs with equal keys and t1 <= t2 <= t1 + span, state bounded by the watermarks of both sides.

    As in the batch join, time buckets join the keys: only neighbours in time are compared, and a frequent key is kept
    in as many state partitions as it has buckets.
    """
    left = with_lateness(a, t1, delay)
    right = with_lateness(b, t2, delay)
    first = time_bucket(t1, seconds)
    near = left.withColumn("__bucket", F.explode(F.array(first, first + 1)))
    names = [f"__r_{i}" for i in range(len(keys))]
    far = right.withColumn("__at", time_bucket(t2, seconds))
    for key, name in zip(keys, names):
        far = far.withColumnRenamed(key, name)
    match = (F.col("__bucket") == F.col("__at")) & (F.col(t2) >= F.col(t1))
    match = match & (F.col(t2) <= F.col(t1) + F.expr(f"interval {seconds} seconds"))
    for key, name in zip(keys, names):
        match = match & (F.col(key) == F.col(name))
    return near.join(far, match).drop("__bucket", "__at", *names)


def dedup(stream: DataFrame, id_cols: Sequence[str], ts: str, delay: str, same_time: bool = True) -> DataFrame:
    """First row per id and event time. With `same_time=False` repeats with another time inside the delay are
    dropped too."""
    late = with_lateness(stream, ts, delay)
    if same_time:
        return late.dropDuplicates([*id_cols, ts])
    return late.dropDuplicatesWithinWatermark(list(id_cols))


def score(stream: DataFrame, watchlist: DataFrame, amount: str, key: str, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Watch-list risk and a decision per row; rows off the list get the default risk and category."""
    listed = enrich(with_lateness(stream, ts, delay), watchlist, key, "left")
    rated = listed.withColumn("merchant_risk", default_to("risk_score", value=DEFAULT_RISK)).withColumn(
        "merchant_category", default_to("category", value=DEFAULT_CATEGORY)
    )
    decision = (
        F.when((F.col(amount) >= BLOCK_AMOUNT) | (F.col("merchant_risk") >= BLOCK_RISK), F.lit(BLOCKED))
        .when(F.col(amount) >= REVIEW_AMOUNT, F.lit(REVIEW))
        .otherwise(F.lit(APPROVED))
    )
    return rated.withColumn("fraud_decision", decision).drop("risk_score", "category")


# Runners


def run_available(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Process what has arrived, append it to the sink once, and stop. Started again with the same checkpoint it goes
    on after the last finished batch."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(sink)


def run_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", idle: bool = True
) -> None:
    """Process what has arrived, handing each micro-batch to `write`.

    `idle=False` is for state of its own, such as that of `running_totals`. Batches without rows are not run: state that
    expires by the clock asks for them without end. Where the session names no other store than Spark's default, which refuses
    such state, this query keeps it in RocksDB. A checkpoint goes on with the store it began with.
    """
    conf = stream.sparkSession.conf
    settings = {NO_DATA_BATCHES: str(idle).lower()}
    if not idle and conf.get(STATE_STORE).endswith(".HDFSBackedStateStoreProvider"):
        settings[STATE_STORE] = ROCKSDB
    former = {name: conf.get(name) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)
    try:
        query = (
            stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .outputMode(mode)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in former.items():
            conf.set(name, value)
    query.awaitTermination()


def stream_commit(stream: DataFrame, root: str, checkpoint: str, now: Callable | None = None) -> DataFrame:
    """Micro-batches as versions of a table, each exactly once."""
    run_batches(stream, versions.commit_batch(root, checkpoint, "append", now), checkpoint)
    return versions.as_of_version(stream.sparkSession, root)


def stream_complete(stream: DataFrame, root: str, checkpoint: str) -> DataFrame:
    """Every trigger replaces the whole result."""
    run_batches(stream, versions.commit_batch(root, checkpoint, "overwrite"), checkpoint, "complete")
    return versions.as_of_version(stream.sparkSession, root)


def stream_upsert(stream: DataFrame, keys: Sequence[str], root: str, checkpoint: str, idle: bool = True) -> DataFrame:
    """Every trigger gives the changed rows only; they replace their keys in the target, of which only the key parts that
    hold them are read and written. A null in a key equals a null, as the stream's grouping has it. A batch that is run again after
    a lost driver writes the same rows again. The micro-batch is kept while it is used, so its state stage runs once."""

    def replace(old: DataFrame, new: DataFrame) -> DataFrame:
        require_unique(new, keys)
        return old.join(new, null_safe(old, new, keys), "left_anti").unionByName(new)

    def write(rows: DataFrame, number: int) -> None:
        kept = rows.persist()
        try:
            load_by_key(root, kept, keys, replace)
        finally:
            kept.unpersist()

    run_batches(stream, write, checkpoint, "update", idle)
    return read_table(stream.sparkSession, root)


BATCH, LATE = "__batch", "__late"
_PLACE = T.StructType([T.StructField(BATCH, T.LongType()), T.StructField(LATE, T.BooleanType())])
_MARKS = "newest timestamp, kept bigint, late bigint, __batch bigint"


def late_marks(spark: SparkSession, root: str) -> DataFrame:
    """What `set_late_aside` did: batch, the newest event time in it, rows kept, rows late."""
    marks = read_partitioned(spark, f"{root}/marks", T.StructType.fromDDL(_MARKS))
    return marks.select(F.col(BATCH).alias("batch"), "newest", "kept", "late")


def window_end(ts: Column | str, seconds: int) -> Column:
    """The end of the fixed window of event time that a row falls into; null without a time."""
    return F.timestamp_seconds((F.floor(F.unix_micros(ts) / (seconds * 1_000_000)) + 1) * seconds)


def set_late_aside(
    stream: DataFrame, ts: str, delay: str, root: str, checkpoint: str, closes: Column | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows): together every row of the stream once, where a watermark would let the late ones vanish.

    A row is late if what it belongs to, such as its window, closed (`closes`, by default its event time) at or before the
    watermark, the newest event time of earlier micro-batches less the delay, which is when a windowed aggregate would
    ignore it. Rows without a time are in time; `window` is no help for `closes`, as it drops them, `window_end` keeps them. A micro-batch is read once and nothing is shuffled; what is carried on is
    one row per batch, with its newest time and both counts.

    Batches are partitions: one that is run again after a lost driver replaces what it wrote, and rows count from the
    moment in which their batch's mark is written.
    """
    spark = stream.sparkSession
    timed = event_time(stream, ts)
    end = F.col(ts) if closes is None else F.expr(closes) if isinstance(closes, str) else closes
    marks = T.StructType.fromDDL(_MARKS)

    def write(rows: DataFrame, number: int) -> None:
        mark = None
        if number > 0:
            past = late_marks(spark, root).where(F.col("batch") < number)
            mark = past.agg(F.unix_micros(F.max("newest") - F.expr(f"interval {delay}"))).first()[0]
        late = F.coalesce(F.unix_micros(end.cast("timestamp")) <= F.lit(mark).cast("bigint"), F.lit(False))
        seen = Observation(f"late-{uuid.uuid4().hex}")
        marked = rows.withColumn(LATE, late).observe(
            seen, F.unix_micros(F.max(ts)).alias("newest"), F.count_if(~F.col(LATE)).alias("kept"), F.count_if(LATE).alias("late")
        )
        marked.withColumn(BATCH, F.lit(number).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(BATCH, LATE).parquet(f"{root}/rows")
        found = seen.get
        values = F.lit(found["newest"]).cast("bigint"), F.lit(found["kept"]), F.lit(found["late"]), F.lit(number)
        one = spark.range(1).select(F.timestamp_micros(values[0]).alias("newest"), *[
            v.cast("bigint").alias(f.name) for v, f in zip(values[1:], marks.fields[1:])
        ])
        replace_parts(one, f"{root}/marks", [BATCH])

    # Folders that a stream without rows can be read from.
    nothing = spark.createDataFrame([], T.StructType([*timed.schema.fields, *_PLACE.fields]))
    nothing.write.mode("append").partitionBy(BATCH, LATE).parquet(f"{root}/rows")
    spark.createDataFrame([], marks).write.mode("append").partitionBy(BATCH).parquet(f"{root}/marks")
    run_batches(timed, write, checkpoint)
    return tuple(_aside(spark, root, timed.schema, late) for late in (False, True))


def _aside(spark: SparkSession, root: str, schema: T.StructType, late: bool) -> DataFrame:
    last = late_marks(spark, root).agg(F.max("batch")).first()[0]
    stored = T.StructType([*schema.fields, *_PLACE.fields])
    rows = read_partitioned(spark, f"{root}/rows", stored)
    return rows.where((F.col(BATCH) <= F.lit(last)) & (F.col(LATE) == late)).select(*schema.names)
