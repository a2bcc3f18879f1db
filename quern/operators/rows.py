"""Row operators: project, filter, sort, limit, sets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.skew import broadcast_if_small
from quern.session import cut_lineage

Order = Sequence[str | tuple[str, str]]


def sort_columns(order: Order) -> list[Column]:
    """`"name"` or `("name", "desc")` to sort expressions."""
    out = []
    for item in order:
        name, direction = (item, "asc") if isinstance(item, str) else item
        out.append(F.col(name).desc() if direction == "desc" else F.col(name).asc())
    return out


# Projection


def rename_select(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select columns under new names: {new: old}."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def select_all(df: DataFrame) -> DataFrame:
    return df.select("*")


def flatten(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Nested fields by dot path as flat columns: {name: path}."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def explode_rows(df: DataFrame, array_col: str, name: str, outer: bool = False) -> DataFrame:
    """One row per array element. Null and empty arrays give no row, or one null row with `outer`."""
    expand = F.explode_outer if outer else F.explode
    others = [c for c in df.columns if c != array_col]
    return df.select(*others, expand(array_col).alias(name))


def pipe(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply steps in order as one expression."""
    return reduce(lambda frame, step: frame.transform(step), steps, df)


# Filters


def where_equal(df: DataFrame, col: str, value, negate: bool = False) -> DataFrame:
    match = F.col(col) == F.lit(value)
    return df.where(~match if negate else match)


def where_all(df: DataFrame, predicates: Sequence[Column | str]) -> DataFrame:
    """Filters one after another; the optimizer joins them into one."""
    return reduce(lambda frame, predicate: frame.where(predicate), predicates, df)


def where_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def where_present(df: DataFrame, col: str, above=None) -> DataFrame:
    """Not null, and above a bound if one is given."""
    keep = F.col(col).isNotNull()
    return df.where(keep if above is None else keep & (F.col(col) > above))


def where_until(df: DataFrame, col: str, as_of: dt.date) -> DataFrame:
    """Dated on or before a day. The bound is put on the raw column, so it reaches the file scan."""
    return df.where(F.col(col) < F.lit(dt.datetime.combine(as_of + dt.timedelta(days=1), dt.time())).cast("timestamp_ntz"))


def where_recent(df: DataFrame, col: str, days: int, as_of: dt.date) -> DataFrame:
    """Dated from `days` days before `as_of` on."""
    start = dt.datetime.combine(as_of - dt.timedelta(days=days), dt.time())
    return df.where(F.col(col) >= F.lit(start).cast("timestamp_ntz"))


def where_param(df: DataFrame, predicate: str, **params) -> DataFrame:
    """A predicate with `:name` parameters, for values that have a default and a run-time override."""
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {predicate}", args=params or None, df=df)


def where_contains(df: DataFrame, array_col: str, value) -> DataFrame:
    return df.where(F.array_contains(array_col, value))


# Nulls


def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def fill(df: DataFrame, values: Mapping) -> DataFrame:
    return df.fillna(dict(values))


# Sort and limit


def sort_by(df: DataFrame, order: Order) -> DataFrame:
    """Global sort. End the list with a unique column: it makes the order repeatable and lets the range
    partitioning cut a frequent leading value into several tasks."""
    return df.orderBy(*sort_columns(order))


def preview(df: DataFrame, n: int = 20, order: Order | None = None) -> DataFrame:
    """The first n rows; with an order, the same ones every time."""
    return (df.orderBy(*sort_columns(order)) if order else df).limit(n)


def top_k(df: DataFrame, col: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """Largest values first. Each task keeps k rows, and only those meet."""
    return df.orderBy(F.col(col).desc(), *tie).limit(k)


# Sets


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def append_rows(df: DataFrame, more: DataFrame, allow_missing: bool = False) -> DataFrame:
    """All rows of both, by column name, duplicates kept."""
    return df.unionByName(more, allowMissingColumns=allow_missing)


def diff(expected: DataFrame, actual: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of one side that the other lacks, with counts respected.

    One grouped pass over both sides: +1 and -1 per row, partial sums before the shuffle, so a row repeated
    very often costs one group entry per task.
    """
    cols = list(cols or expected.columns)
    sides = expected.select(*cols, F.lit(1).alias("__n")).unionByName(actual.select(*cols, F.lit(-1).alias("__n")))
    net = sides.groupBy(*cols).agg(F.sum("__n").alias("__net")).where(F.col("__net") != 0)
    side = F.when(F.col("__net") > 0, F.lit("missing")).otherwise(F.lit("unexpected")).alias("side")
    return net.select(*cols, side, F.abs("__net").alias("copies"))


#: Parts that rows are digested in where the caller names none.
DIGEST_PARTS = 4096


def _digest(side: DataFrame, part: Column, cols: Sequence[str], sign: int) -> DataFrame:
    """Per part: rows, and two sums of independent hashes of the rows, which do not depend on their order.

    Hashes pass nulls over, so each column is hashed next to whether it is null.
    """
    flat = [c for name in cols for c in (F.col(name), F.col(name).isNull())]
    wide = "decimal(20,0)"
    first, second = F.xxhash64(*flat).cast(wide), F.xxhash64(F.lit("second"), *flat).cast(wide)
    return side.select(
        part.alias("__part"), F.lit(sign).alias("__n"), (first * sign).cast(wide).alias("__a"), (second * sign).cast(wide).alias("__b")
    )


def _alike(expected: DataFrame, actual: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns in types that hold either side's values: hashes differ between types."""
    types = expected.select(*cols).union(actual.select(*cols)).schema
    return tuple(side.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in types]) for side in (expected, actual))


def changed_parts(expected: DataFrame, actual: DataFrame, part: Column, cols: Sequence[str]) -> DataFrame:
    """Parts whose rows differ between the sides (`__part`). Only the digests move, combined inside the tasks before that;
    parts that differ are taken for equal with a probability of about 2^-120."""
    sides = _digest(expected, part, cols, 1).unionByName(_digest(actual, part, cols, -1))
    net = sides.groupBy("__part").agg(*[F.sum(c).alias(c) for c in ("__n", "__a", "__b")])
    return net.where("__n <> 0 OR __a <> 0 OR __b <> 0").select("__part")


def diff_by_parts(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None, part: Column | None = None
) -> DataFrame:
    """The rows of `diff`, for large tables that differ in little: digests tell in which parts of the key the sides differ,
    and no row of another part is moved. Both tables are read twice.

    `part` is an expression over the key, the same for rows that may be compared; by default it is one of DIGEST_PARTS hashed
    parts. Where tables are laid out by a range of the key (a day, a thousand ids), that range makes fewer digests per task.
    Rows of a null part are compared like others.
    """
    cols = list(cols or expected.columns)
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"keys are not compared: {missing}")
    expected, actual = _alike(expected, actual, cols)
    if part is None:
        part = F.pmod(F.xxhash64(*keys), F.lit(DIGEST_PARTS))
    changed = cut_lineage(changed_parts(expected, actual, part, cols))
    near = broadcast_if_small(changed)
    sides = [
        side.withColumn("__at", part).join(near, F.col("__at").eqNullSafe(F.col("__part")), "left_semi").drop("__at")
        for side in (expected, actual)
    ]
    return diff(*sides, cols)
