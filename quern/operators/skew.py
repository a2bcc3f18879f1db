"""Groups too large for one task: finding them, and checking what may be broadcast."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import cut_lineage

# A group with more rows than this is never handled by a single task.
GROUP_LIMIT = 5_000_000

# What a broadcast side may hold at most.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], other: Sequence[str] | None = None) -> Column:
    """Equality on all columns, with null equal to null, as grouping sees it."""
    pairs = zip(cols, other or cols)
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[o]) for c, o in pairs])


def row_bytes(df: DataFrame) -> Column:
    """Rough size of a row: 8 bytes per plain value, text and binary by length, nested values as JSON."""
    size = F.lit(0)
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            part = F.octet_length(col)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            part = F.length(F.to_json(F.struct(col)))
        else:
            part = F.lit(8)
        size = size + F.coalesce(part, F.lit(0))
    return size


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure a possible broadcast side: one pass, summed inside the tasks, nothing moved."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df).cast("bigint")).alias("bytes")).first()
    return found.n <= rows and (found.bytes or 0) <= size


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark for broadcast when measured small; otherwise leave the choice to the optimizer."""
    return F.broadcast(df) if small_enough(df, rows, size) else df


def hot_keys(df: DataFrame, by: Sequence[str], limit: int = GROUP_LIMIT) -> DataFrame:
    """Groups over the limit with their row counts.

    Counts are partly summed before the shuffle, and a table of N rows has at most N / limit such groups, which
    bounds the result.
    """
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > limit)


def split_hot(
    df: DataFrame, by: Sequence[str], limit: int | None = GROUP_LIMIT
) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of ordinary groups, rows of hot groups or None, number of hot rows).

    With a small limit there can be many hot groups, so their list is measured before it is broadcast.
    """
    if limit is None:
        return df, None, 0
    hot = cut_lineage(hot_keys(df, by, limit))
    total = hot.agg(F.sum("__rows")).first()[0]
    if not total:
        return df, None, 0
    names = [f"__hot_{i}" for i in range(len(by))]
    marks = broadcast_if_small(hot.select(*[F.col(c).alias(n) for c, n in zip(by, names)]))
    same = null_safe(df, marks, by, names)
    return df.join(marks, same, "left_anti"), df.join(marks, same, "left_semi"), total


def salt_of(row_key: Sequence[str], n: Column) -> Column:
    """A number in 0 … n-1 that a retried task computes again for the same row."""
    return F.pmod(F.xxhash64(*row_key), n).cast("int")


def parts_for(df: DataFrame, rows: int, at_least: int = 1) -> int:
    """How many parts of about `rows` rows a frame makes. Counting reads no columns."""
    return max(at_least, math.ceil(df.count() / rows))
