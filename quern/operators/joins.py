"""Joins: plain, broadcast behind a size check, sort-merge, salted, point-in-time, time range."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.skew import GROUP_LIMIT, broadcast_if_small, hot_keys, salt_of
from quern.operators.windows import carry_forward
from quern.session import cut_lineage

Keys = Sequence[str | tuple[str, str]]


def equal(left: DataFrame, right: DataFrame, keys: Keys) -> Column:
    """`"k"` means the same name on both sides, `("a", "b")` left a = right b."""
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    return reduce(lambda a, b: a & b, [left[x] == right[y] for x, y in pairs])


def _join(left: DataFrame, right: DataFrame, keys: Keys, how: str) -> DataFrame:
    joined = left.join(right, equal(left, right, keys), how)
    # A name both sides share is kept once, from the left.
    for key in keys:
        if isinstance(key, str):
            joined = joined.drop(right[key])
    return joined


def join_on(left: DataFrame, right: DataFrame, keys: Keys, how: str = "inner") -> DataFrame:
    """Equi-join; the optimizer picks the strategy and AQE splits skewed keys."""
    return _join(left, right, keys, how)


def join_small(fact: DataFrame, dim: DataFrame, keys: Keys, how: str = "inner") -> DataFrame:
    """Join a dimension without moving the fact, if the dimension measures small enough to broadcast."""
    checked = broadcast_if_small(dim)
    return _join(fact, checked, keys, how)


def join_large(left: DataFrame, right: DataFrame, keys: Keys, how: str = "inner") -> DataFrame:
    """Sort-merge join by a hint on this join alone."""
    return _join(left, right.hint("merge"), keys, how)


def left_summary(left: DataFrame, right: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Left rows with aggregates of their right rows; null where there are none.

    The right side is aggregated first: what is shuffled for the join is one row per key.
    """
    return left.join(right.groupBy(*keys).agg(*aggs), list(keys), "left")


def join_many(fact: DataFrame, steps: Sequence[tuple[DataFrame, Column, str]]) -> DataFrame:
    """Join several aliased frames in turn: (frame, condition, how)."""
    return reduce(lambda frame, step: frame.join(step[0], step[1], step[2]), steps, fact)


def star_join(fact: DataFrame, dim: DataFrame, key: str, dim_predicate: Column | str) -> DataFrame:
    """Filter the dimension; its surviving keys decide at run time which fact partitions are read."""
    return fact.join(broadcast_if_small(dim.where(dim_predicate)), key)


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose key has no parent; a null key is not an orphan."""
    known = parent.select(F.col(parent_col).alias("__parent")).where("__parent is not null")
    return child.where(F.col(child_col).isNotNull()).join(known, F.col(child_col) == F.col("__parent"), "left_anti")


def salt_pair(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    row_key: Sequence[str],
    n: int | None = None,
    limit: int = GROUP_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """Give both sides a `__salt` so that (keys, salt) joins like keys alone.

    With `n` every key is spread over n salts and every dimension row copied n times. Without it only fact keys with
    more than `limit` rows are, over as many salts as they hold limits: that is at most rows / limit keys, and twice
    as many copies.
    """
    if n is not None:
        copies = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        return fact.withColumn("__salt", salt_of(row_key, F.lit(n))), dim.withColumn("__salt", copies)
    hot = cut_lineage(hot_keys(fact.dropna(subset=list(keys)), keys, limit))
    salts = F.ceil(F.col("__rows") / F.lit(limit)).cast("int").alias("__salts")
    hot = F.broadcast(hot.select(*keys, salts))
    salts = F.coalesce("__salts", F.lit(1))
    spread = fact.join(hot, list(keys), "left").withColumn("__salt", salt_of(row_key, salts))
    copied = dim.join(hot, list(keys), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return spread.drop("__salts"), copied.drop("__salts")


def join_salted(
    fact: DataFrame, dim: DataFrame, key: str, row_key: Sequence[str], n: int | None = None, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Inner join with keys cut into parts by `salt_pair`; the rows equal those of the plain join."""
    salted, copied = salt_pair(fact, dim, [key], row_key, n, limit)
    return salted.join(copied, [key, "__salt"]).drop("__salt")


def join_point_in_time(
    fact: DataFrame,
    hist: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Each fact with the version of its key that was valid at `at`; start included, end excluded, left join.

    Versions of one key must not overlap, which histories guarantee. Facts and versions are sorted together once
    and the latest version is carried forward, so the work is linear in both sides, where joining on the key and
    filtering by time would pair every fact with every version of its key.
    """
    fields = [c for c in hist.columns if c not in keys]
    fact_fields = [F.col(c).alias(f"__f_{i}") for i, c in enumerate(fact.columns)]
    key_names = [f"__key_{i}" for i in range(len(keys))]
    usable = hist.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    versions = usable.dropna(subset=list(keys)).select(
        *[F.col(k).alias(n) for k, n in zip(keys, key_names)],
        F.col(start).alias("__t"),
        F.lit(0).alias("__kind"),
        F.struct(*fields).alias("__version"),
    )
    facts = fact.select(
        *[F.col(k).alias(n) for k, n in zip(keys, key_names)],
        F.col(at).alias("__t"),
        F.lit(1).alias("__kind"),
        F.struct(*fact_fields).alias("__fact"),
    )
    both = versions.unionByName(facts, allowMissingColumns=True)
    filled = carry_forward(both, key_names, ["__t", "__kind"], "__version", "__found", limit).where("__kind = 1")
    valid = F.col("__t").isNotNull() & (
        F.col(f"__found.{end}").isNull() | (F.col("__t") < F.col(f"__found.{end}"))
    )
    return filled.select(
        *[F.col(f"__fact.__f_{i}").alias(c) for i, c in enumerate(fact.columns)],
        *[F.when(valid, F.col(f"__found.{c}")).alias(c) for c in fields],
    )


def time_bucket(ts: str, seconds: int) -> Column:
    """Number of the `seconds`-long interval that a timestamp falls in."""
    micros, span = f"unix_micros(cast(`{ts}` as timestamp))", f"{seconds * 1_000_000}L"
    # Whole numbers throughout, and rounded down before 1970 as well.
    return F.expr(f"({micros} - pmod({micros}, {span})) div {span}")


def join_within(left: DataFrame, right: DataFrame, keys: Sequence[str], t1: str, t2: str, seconds: int) -> DataFrame:
    """Pairs with equal keys and t1 <= t2 <= t1 + span; the sides must not share other column names.

    Time is cut into buckets one span long, which join the keys: a left row looks into its own bucket and the next,
    a right row sits in one, so each pair is found exactly once and only neighbours in time are compared. It also
    spreads a frequent key over as many tasks as it has buckets.
    """
    first = time_bucket(t1, seconds)
    near = left.withColumn("__bucket", F.explode(F.array(first, first + 1)))
    far = right.select(
        *[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)],
        time_bucket(t2, seconds).alias("__at"),
        *[c for c in right.columns if c not in keys],
    )
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__r_{i}") for i, k in enumerate(keys)])
    in_span = (F.col(t2) >= F.col(t1)) & (F.col(t2) <= F.col(t1) + F.make_dt_interval(secs=F.lit(seconds)))
    joined = near.join(far, same & (F.col("__bucket") == F.col("__at")) & in_span)
    return joined.drop("__bucket", "__at", *[f"__r_{i}" for i in range(len(keys))])
