"""Window functions that hold when one group has a large share of all rows.

Ordinary groups use Spark's window functions as they are. A group over `limit` rows is cut into consecutive
ranges of its sort order. Each range is one group for a local window; what the earlier ranges add up to is a
small table (one row per range) joined back on. Results equal the plain window's, but that sums of doubles are added in
another order; sum decimals to be exact.

Looking for large groups costs one pass that reads the group columns only. `limit=None` leaves it out, for groups whose
size is bounded by what they are (one row per day, say).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.rows import Order, sort_columns
from quern.operators.skew import GROUP_LIMIT, null_safe, small_enough, split_hot
from quern.session import cut_lineage

RUNNING = (Window.unboundedPreceding, Window.currentRow)
BEFORE = (Window.unboundedPreceding, -1)

#: A range is a task and a file. A small limit makes no more of them than this, unless they would exceed GROUP_LIMIT rows.
RANGES = 200


def _range_count(rows: int, limit: int) -> int:
    """Ranges of `limit` rows; longer ones where these would be many tasks with little to do."""
    return max(2, min(math.ceil(rows / limit), max(RANGES, math.ceil(rows / GROUP_LIMIT))))


def _cut(hot: DataFrame, by: Sequence[str], order: Order, rows: int, limit: int) -> DataFrame:
    """Hot rows with `__block`, increasing along the order inside each group. Rows of one sort value go on by a hash of
    the row, so that any number of them can be cut.

    Bounds of ranges are sampled anew by each job, so what is used twice is to be written once.
    """
    hashable = [f.name for f in hot.schema if not isinstance(f.dataType, T.MapType)]
    ties = F.xxhash64(*[F.col(f"`{c}`") for c in hashable])
    placed = hot.repartitionByRange(_range_count(rows, limit), *[F.col(c) for c in by], *sort_columns(order), ties)
    return placed.withColumn("__block", F.spark_partition_id())


def _ranges(hot: DataFrame, by: Sequence[str], order: Order, rows: int, limit: int) -> DataFrame:
    """The checkpoint fixes which row is in which range, so every later use agrees even after a lost executor."""
    return cut_lineage(_cut(hot, by, order, rows, limit))


def _with_carry(blocks: DataFrame, by: Sequence[str], totals: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
    """Add per-range values combined over the earlier ranges of the same group.

    `totals` are aggregates per range; `carry` are window expressions over them. Only a group that goes on from one range
    into the next has something to carry: at most one row per bound of ranges, however many groups there are, hence
    safe to broadcast.
    """
    before = Window.partitionBy(*by).orderBy("__block").rowsBetween(*BEFORE)
    per_block = blocks.groupBy(*by, "__block").agg(*[v.alias(k) for k, v in totals.items()])
    names = [f"__by_{i}" for i in range(len(by))]
    carried = per_block.select(
        *[F.col(c).alias(n) for c, n in zip(by, names)],
        F.col("__block").alias("__b"),
        *[v.over(before).alias(k) for k, v in carry.items()],
    ).where(reduce(or_, [F.col(k).isNotNull() for k in carry]))
    same = null_safe(blocks, carried, by, names) & (F.col("__block") == F.col("__b"))
    return blocks.join(F.broadcast(carried), same, "left").drop(*names, "__b")


def _add_sums(
    df: DataFrame, by: Sequence[str], order: Order, sums: dict[str, tuple[Column, Column]], limit: int | None
) -> DataFrame:
    """Columns that grow along the order: {name: (window function, aggregate over a whole range)}, of the aggregate's
    type. In hot groups the value is what the earlier ranges add up to plus the local one."""
    plain = Window.partitionBy(*by).orderBy(*sort_columns(order)).rowsBetween(*RUNNING)
    cold, hot, rows = split_hot(df, by, limit)
    types = df.select(*[total.alias(name) for name, (_, total) in sums.items()]).schema
    out = cold
    for name, (running, _) in sums.items():
        out = out.withColumn(name, running.over(plain).cast(types[name].dataType))
    if hot is None:
        return out
    local = Window.partitionBy(*by, "__block").orderBy(*sort_columns(order)).rowsBetween(*RUNNING)
    names = list(sums)
    blocks = _cut(hot, by, order, rows, limit)
    for i, name in enumerate(names):
        blocks = blocks.withColumn(f"__here_{i}", sums[name][0].over(local))
    blocks = cut_lineage(blocks)
    totals = {f"__total_{i}": sums[n][1] for i, n in enumerate(names)}
    carried = _with_carry(blocks, by, totals, {f"__before_{i}": F.sum(f"__total_{i}") for i in range(len(names))})
    for i, name in enumerate(names):
        here, before = F.col(f"__here_{i}"), F.col(f"__before_{i}")
        # Null until the first value, as a plain running sum is.
        total = F.coalesce(before + here, before, here)
        carried = carried.withColumn(name, total.cast(types[name].dataType))
    return out.unionByName(carried.select(*out.columns))


def add_row_number(
    df: DataFrame, by: Sequence[str], order: Order, name: str = "row_number", limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """1, 2, 3 … inside each group. Let the order end with a unique column."""
    return _add_sums(df, by, order, {name: (F.row_number(), F.count(F.lit(1)))}, limit)


def add_running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    col: str,
    name: str = "running_total",
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """Cumulative sum from the first row of the group to the current one."""
    return _add_sums(df, by, order, {name: (F.sum(col), F.sum(col))}, limit)


def add_neighbours(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    col: str,
    n: int = 1,
    names: tuple[str, str] = ("previous", "next"),
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """Value n rows before and n rows after; null past either end.

    In hot groups both are looked up inside each range. Only the n rows at either end of a range are numbered through
    and matched by number, at most n pairs for each bound of ranges, which spreads one group over all tasks.
    """
    plain = Window.partitionBy(*by).orderBy(*sort_columns(order))
    cold, hot, rows = split_hot(df, by, limit)
    out = cold.withColumn(names[0], F.lag(col, n).over(plain)).withColumn(names[1], F.lead(col, n).over(plain))
    if hot is None:
        return out
    local = Window.partitionBy(*by, "__block").orderBy(*sort_columns(order))
    edge = F.lag(F.lit(1), n).over(local).isNull() | F.lead(F.lit(1), n).over(local).isNull()
    near = cut_lineage(
        _cut(hot, by, order, rows, limit)
        .withColumn(names[0], F.lag(col, n).over(local))
        .withColumn(names[1], F.lead(col, n).over(local))
        .withColumn("__pos", F.row_number().over(local))
        .withColumn("__edge", edge)
    )
    counted = _with_carry(near, by, {"__rows": F.count(F.lit(1))}, {"__before": F.sum("__rows")}).where("__edge")
    at = F.coalesce(F.col("__before"), F.lit(0)) + F.col("__pos")
    keys, places = [f"__by_{i}" for i in range(len(by))], ("__later", "__earlier")
    later, earlier = (
        counted.select(
            *[F.col(c).alias(k) for c, k in zip(by, keys)],
            F.struct("__block", "__pos", F.col(col).alias("value")).alias(place),
            (at + step).alias("__at"),
        )
        for place, step in zip(places, (0, n))
    )
    match = null_safe(later, earlier, keys) & (later["__at"] == earlier["__at"])
    apart = F.col("__later.__block") != F.col("__earlier.__block")
    pairs = cut_lineage(later.join(earlier, match & apart).select(*[later[k] for k in keys], *places))
    small = small_enough(pairs)
    for name, here, there in zip(names, places, reversed(places)):
        side = pairs.select(
            *keys,
            F.col(f"{here}.__block").alias("__b"),
            F.col(f"{here}.__pos").alias("__p"),
            F.col(f"{there}.value").alias("__value"),
        )
        side = F.broadcast(side) if small else side
        same = null_safe(near, side, by, keys) & (F.col("__block") == F.col("__b")) & (F.col("__pos") == F.col("__p"))
        found = F.coalesce(F.col(name), F.col("__value"))
        near = near.join(side, same, "left").withColumn(name, found).drop(*keys, "__b", "__p", "__value")
    return out.unionByName(near.select(*out.columns))


def add_ranks(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    names: tuple[str, str] = ("rank", "dense_rank"),
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """Rank with gaps and without.

    Both depend on the sort values only. In hot groups they are found on one row per distinct value, however
    often the value repeats, and joined back.
    """
    plain = Window.partitionBy(*by).orderBy(*sort_columns(order))
    cold, hot, _ = split_hot(df, by, limit)
    out = cold.withColumn(names[0], F.rank().over(plain).cast("bigint")).withColumn(
        names[1], F.dense_rank().over(plain).cast("bigint")
    )
    if hot is None:
        return out
    values = [item if isinstance(item, str) else item[0] for item in order]
    one = F.count(F.lit(1))
    distinct = cut_lineage(hot.groupBy(*by, *values).agg(one.alias("__n")))
    counted = {"__dense": (F.row_number(), one), "__upto": (F.sum("__n"), F.sum("__n"))}
    ranked = _add_sums(distinct, by, order, counted, limit)
    cols = [*by, *values]
    keys = [f"__by_{i}" for i in range(len(cols))]
    side = ranked.select(
        *[F.col(c).alias(k) for c, k in zip(cols, keys)],
        (F.col("__upto") - F.col("__n") + 1).alias(names[0]),
        F.col("__dense").alias(names[1]),
    )
    back = hot.join(side, null_safe(hot, side, cols, keys), "left").drop(*keys)
    return out.unionByName(back.select(*out.columns))


def carry_forward(
    df: DataFrame, by: Sequence[str], order: Order, col: str, name: str, limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """The latest non-null value at or before each row of the group."""
    plain = Window.partitionBy(*by).orderBy(*sort_columns(order)).rowsBetween(*RUNNING)
    cold, hot, rows = split_hot(df, by, limit)
    out = cold.withColumn(name, F.last(col, ignorenulls=True).over(plain))
    if hot is None:
        return out
    blocks = _ranges(hot, by, order, rows, limit)
    local = Window.partitionBy(*by, "__block").orderBy(*sort_columns(order)).rowsBetween(*RUNNING)
    # The last value of a range: the greatest position in sort order among its non-null rows.
    at = F.when(F.col(col).isNotNull(), F.col("__pos"))
    placed = cut_lineage(blocks.withColumn("__pos", F.row_number().over(local)))
    carried = _with_carry(
        placed, by, {"__last": F.max_by(col, at)}, {"__before": F.last("__last", ignorenulls=True)}
    )
    here = F.last(col, ignorenulls=True).over(local)
    filled = carried.withColumn(name, F.coalesce(here, F.col("__before")))
    return out.unionByName(filled.select(*out.columns))


def rank_totals(
    df: DataFrame, by: str, within: str, col: str, limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """Sum per (within, by), then rank the sums inside `within`, largest first; ties go by name."""
    totals = df.groupBy(within, by).agg(F.sum(col).alias("total_revenue"), F.count(F.lit(1)).alias("order_count"))
    totals = cut_lineage(totals)  # summed once, though looked at twice
    return add_row_number(totals, [within], [("total_revenue", "desc"), by], f"{by}_rank", limit)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest order values (the last columns break ties).

    An aggregate rather than a window: each task sorts its rows by key and sends one row per key, so the shuffle of a
    key with very many copies is as small as that of any other.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*df.columns)
