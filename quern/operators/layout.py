"""Partition counts, custom partitions, caching, skew report, counters."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quern.operators.skew import salt_of
from quern.session import cut_lineage


def repartitioned(df: DataFrame, n: int, by: Sequence[str] | None = None) -> DataFrame:
    """n partitions by shuffle. Without columns the rows are hashed whole: a retried task sends each row to the same
    place, which round-robin does not promise."""
    return df.repartition(n, *(by or [F.xxhash64(*df.columns)]))


def coalesced(df: DataFrame, n: int) -> DataFrame:
    """At most n partitions, without a shuffle."""
    return df.coalesce(n)


def with_cached(
    df: DataFrame, fns: Sequence[Callable[[DataFrame], object]], level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> list:
    """Compute one frame once, take several results from it, release it. The functions must return values or frames
    that no longer depend on the cache."""
    held = df.persist(level)
    try:
        return [fn(held) for fn in fns]
    finally:
        held.unpersist()


def skew_report(df: DataFrame, key: str, factor: float) -> DataFrame:
    """Rows per key against the exact median of all keys, with hot keys flagged.

    The median is taken over (row count, number of keys with it): N rows give at most sqrt(2N) different counts,
    a small table for one task.
    """
    per_key = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_per_key")))  # counted once
    frequency = per_key.groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("__keys"))
    median = frequency.agg(F.percentile("rows_per_key", F.lit(0.5), F.col("__keys"))).first()[0]
    return per_key.select(
        key,
        "rows_per_key",
        F.lit(median).cast("double").alias("median_rows"),
        (F.col("rows_per_key") > F.lit(median) * F.lit(float(factor))).alias("is_hot"),
    )


#: Counters of the sketch per key that may be hot. Its counts are off by at most 3.5 / counters of all rows.
COUNTERS = 16


def hot_list(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys with more than this share of all rows, null among them, with exact counts: (key, rows_per_key).

    A sketch of frequent items, merged from all tasks, nominates at most 2 / share keys, and a second pass counts these
    only. Keys are not shuffled: what moves is a sketch per task, and then a row per nominee and task. The report of all
    keys is `skew_report`.
    """
    counters = 1 << math.ceil(math.log2(COUNTERS / share))
    if not 0 < share < 1 or counters > 1_000_000:
        raise ValueError(f"a share of {share} is outside what the sketch can tell")
    sketch = F.call_function("approx_top_k", F.col(key), F.lit(math.ceil(2 / share)), F.lit(counters)).alias("top")
    seen = cut_lineage(df.agg(F.count(F.lit(1)).alias("n"), sketch))
    least = seen.first().n * share
    nominees = seen.select(F.explode("top").alias("t")).select(F.col("t.item").alias("__item"))
    nominees = nominees.unionByName(df.sparkSession.range(1).select(F.lit(None).cast(df.schema[key].dataType).alias("__item"))).distinct()
    kept = df.select(key).join(F.broadcast(nominees), F.col(key).eqNullSafe(F.col("__item")), "left_semi")
    counted = kept.groupBy(key).agg(F.count(F.lit(1)).alias("rows_per_key"))
    return counted.where(F.col("rows_per_key") > F.lit(least))


def region_buckets(value: Column | str, mapping: Mapping[int, Sequence[str]], default: int) -> Column:
    """Bucket number by key: {bucket: keys}."""
    key = F.upper(F.col(value) if isinstance(value, str) else value)
    out = F.lit(default)
    for bucket, members in reversed(list(mapping.items())):
        out = F.when(key.isin(list(members)), F.lit(bucket)).otherwise(out)
    return out


def partition_by_bucket(df: DataFrame, bucket: str, buckets: int, per_bucket: int, row_key: Sequence[str]) -> DataFrame:
    """Place rows by bucket number, each bucket over `per_bucket` partitions that no other bucket uses, so a bucket
    with most of the rows is still shared by several tasks."""
    place = (F.col(bucket) * per_bucket + salt_of(row_key, F.lit(per_bucket))).cast("int")
    return df.repartitionById(buckets * per_bucket, place)


def partition_sizes(df: DataFrame, label: str) -> DataFrame:
    """Rows per physical partition and label."""
    return df.groupBy(F.spark_partition_id().alias("partition_id"), label).agg(F.count(F.lit(1)).alias("row_count"))


def observe_errors(df: DataFrame, predicate: Column, name: str = "errors") -> tuple[DataFrame, Observation]:
    """Count matching rows while the frame is being computed.

    The metric is taken once per finished query, so a retried task is not counted twice.
    """
    watch = Observation(name)
    return df.observe(
        watch, F.count(F.lit(1)).alias("seen"), F.count(F.when(predicate, F.lit(1))).alias("matched")
    ), watch


def even_squares(df: DataFrame, col: str) -> DataFrame:
    """Even values and their squares; decimals keep the square of a large number exact."""
    return df.where(F.col(col) % 2 == 0).select(
        F.col(col).alias("value"), (F.col(col).cast("decimal(19,0)") * F.col(col).cast("decimal(19,0)")).alias("square")
    )
