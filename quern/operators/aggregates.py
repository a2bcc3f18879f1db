"""Grouped summaries and pivots. All aggregates combine inside tasks before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.joins import join_on
from quern.operators.rows import drop_null_keys, where_equal
from quern.operators.skew import broadcast_if_small, null_safe
from quern.session import cut_lineage

#: Values of one map of `pivot_blocks`, on average.
BLOCK_VALUES = 10_000


def count_by(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count"))


def summarise(df: DataFrame, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*aggs)


def sum_by(df: DataFrame, by: Sequence[str], col: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(col).alias(name))


def count_and_sum(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.sum(col).alias("total"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def mean(col: str) -> Column:
    """Average of exact decimals as a double: one division, whatever the row order."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col).cast("double"))


def pivot_sum(df: DataFrame, by: Sequence[str], pivot_col: str, value_col: str, values: Sequence[str]) -> DataFrame:
    """One summed column per listed value, 0 where a group has none. The list fixes the schema, and needs one pass."""
    sums = [
        F.sum(F.when(F.col(pivot_col) == v, F.col(value_col)).otherwise(F.lit(0))).alias(f"{v}_amount")
        for v in values
    ]
    return df.groupBy(*by).agg(*sums)


def pivot_map(df: DataFrame, by: Sequence[str], pivot_col: str, value_col: str, name: str = "amounts") -> DataFrame:
    """One map per group from each value of the pivot column that occurs in it to its sum; null values are left out.

    Values need not be known and may be any number: sums are made per group and value, and no list of values reaches the
    driver. `pivot_sum` gives columns for values that the caller lists.
    """
    sums = df.where(F.col(pivot_col).isNotNull()).groupBy(*by, pivot_col).agg(F.sum(value_col).alias("__sum"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(pivot_col), F.col("__sum"))))
    return sums.groupBy(*by).agg(F.map_from_entries(entries).alias(name))


def pivot_blocks(
    df: DataFrame, by: Sequence[str], pivot_col: str, value_col: str, size: int = BLOCK_VALUES, name: str = "amounts"
) -> DataFrame:
    """`pivot_map` in blocks of about `size` values: (by, block, map). A group of few values is one block, number 0; one of
    many is spread over as many rows as it needs, and no task or row holds it whole.

    The values of a block follow from their hash, so a value is looked up in one block: `block_of` gives its number from
    `blocks`, the number of its group's blocks.
    """
    sums = df.where(F.col(pivot_col).isNotNull()).groupBy(*by, pivot_col).agg(F.sum(value_col).alias("__sum"))
    sums = cut_lineage(sums)
    blocks = F.ceil(F.col("__values") / F.lit(size)).cast("int").alias("blocks")
    # Groups of more than `size` values: at most values / size of them.
    wide = sums.groupBy(*by).agg(F.count(F.lit(1)).alias("__values")).where(F.col("__values") > size)
    wide = broadcast_if_small(cut_lineage(wide.select(*[F.col(c).alias(f"__by_{i}") for i, c in enumerate(by)], blocks)))
    near = sums.join(wide, null_safe(sums, wide, by, [f"__by_{i}" for i in range(len(by))]), "left")
    near = near.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", block_of(F.col(pivot_col), F.col("blocks")))
    entries = F.sort_array(F.collect_list(F.struct(F.col(pivot_col), F.col("__sum"))))
    return near.groupBy(*by, "block", "blocks").agg(F.map_from_entries(entries).alias(name))


def block_of(value: Column, blocks: Column) -> Column:
    """The block that `pivot_blocks` puts a value into."""
    return F.pmod(F.xxhash64(value), blocks).cast("int")


def high_watermark(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias("high_watermark"))


def latency_summary(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("hits"), mean(col).alias("avg_response"))


def country_revenue(orders: DataFrame, users: DataFrame, completed: str = "COMPLETED") -> DataFrame:
    """Completed orders per country: count, revenue, average.

    Orders are summed per user before the join, so a user with very many orders joins as one row.
    """
    clean = where_equal(drop_null_keys(orders, ["order_id", "user_id"]), "status", completed)
    per_user = clean.groupBy("user_id").agg(
        F.count("order_id").alias("__n"), F.sum("amount").alias("__sum"), F.count("amount").alias("__filled")
    )
    joined = join_on(per_user, users.select("id", "country"), [("user_id", "id")])
    return joined.groupBy("country").agg(
        F.sum("__n").alias("order_count"),
        F.sum("__sum").alias("total_revenue"),
        F.try_divide(F.sum("__sum").cast("double"), F.sum("__filled").cast("double")).alias("avg_order_value"),
    )
