"""Work that is done on parts: diffs by digests, hot lists by sketches, pivots in blocks."""

import random

import pytest
from pyspark.sql import functions as F

from quern.operators import aggregates as A
from quern.operators import layout as L
from quern.operators import rows as R
from tests.conftest import rows_of


def pair_of_tables(spark):
    base = spark.range(5000).select("id", F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("v"), F.lit(None).cast("int").alias("w"))
    moved = base.withColumn("v", F.when(F.col("id") == 1234, F.lit(None)).otherwise(F.col("v")))
    moved = moved.withColumn("w", F.when(F.col("id") == 1234, F.lit(1234)))
    return base, moved.orderBy(F.rand(3))


def test_only_parts_that_differ_are_compared(spark):
    base, moved = pair_of_tables(spark)
    part = F.floor(F.col("id") / 100)
    assert rows_of(R.changed_parts(base, moved, part, base.columns)) == [(12,)]
    out = R.diff_by_parts(base, moved, ["id"], part=part)
    assert rows_of(out) == rows_of(R.diff(base, moved)) and out.count() == 2
    assert rows_of(R.diff_by_parts(base, moved, ["id"])) == rows_of(out)


@pytest.mark.parametrize("seed", range(3))
def test_diff_by_parts_equals_diff(spark, seed):
    """Repeated rows, nulls in key and value, swapped values, and whole numbers of two widths."""
    rnd = random.Random(seed)

    def some(n):
        return [(rnd.choice([None, *range(12)]), rnd.choice([None, "a", "b"]), rnd.choice([None, "a", "b"])) for _ in range(n)]

    shared = some(40)
    left = spark.createDataFrame(shared + some(3), "k bigint, a string, b string")
    right = spark.createDataFrame(shared + [(k, b, a) for k, a, b in some(3)], "k int, a string, b string")
    for part in (None, F.col("k"), F.floor(F.col("k") / 4)):
        assert rows_of(R.diff_by_parts(left, right, ["k"], part=part)) == rows_of(R.diff(left, right))


def test_diff_by_parts_of_equal_and_empty_tables(spark):
    base, _ = pair_of_tables(spark)
    assert R.diff_by_parts(base, base.repartition(3, "v"), ["id"]).isEmpty()
    assert R.diff_by_parts(base.limit(0), base.limit(0), ["id"]).isEmpty()
    assert R.diff_by_parts(base, base.limit(0), ["id"]).count() == 5000
    with pytest.raises(ValueError, match="not compared"):
        R.diff_by_parts(base, base, ["id"], cols=["v"])


@pytest.mark.parametrize("seed", range(2))
def test_hot_list_is_exact(spark, seed):
    rnd = random.Random(seed)
    keys = [k for k in range(1, 40) for _ in range(rnd.choice([99, 100, 101, 5]))] + list(range(1000, 5000)) + [None] * 300
    keys += [0] * (10_000 - len(keys))  # ties at the limit: a share of 0.01 is 100 rows
    df = spark.createDataFrame([(k, str(k)) for k in keys], "k int, t string").repartition(7)
    want = {k: keys.count(k) for k in set(keys) if keys.count(k) > 100}
    assert None in want and want == {r.k: r.rows_per_key for r in L.hot_list(df, "k", 0.01).collect()}
    text = {r.t: r.rows_per_key for r in L.hot_list(df, "t", 0.01).collect()}
    assert text == {str(k): n for k, n in want.items()}


def test_hot_list_shuffles_no_keys_and_takes_an_empty_table(spark):
    df = spark.range(2000).select((F.col("id") % 5).alias("k"))
    plan = L.hot_list(df, "k", 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert L.hot_list(df.limit(0), "k", 0.1).isEmpty()
    with pytest.raises(ValueError, match="share"):
        L.hot_list(df, "k", 1e-9)


def test_pivot_in_blocks(spark):
    rows = [("wide", k, k) for k in range(1000)] + [("wide", 3, 10), (None, 1, 5), ("thin", 2, None), ("thin", None, 1)]
    df = spark.createDataFrame(rows, "g string, k int, v bigint")
    out = A.pivot_blocks(df, ["g"], "k", "v", size=50)
    sizes = [len(r.amounts) for r in out.where("g = 'wide'").collect()]
    assert len(sizes) == 20 and sum(sizes) == 1000 and max(sizes) < 100
    whole = A.pivot_map(df, ["g"], "k", "v")
    back = out.select("g", F.explode("amounts")), whole.select("g", F.explode("amounts"))
    assert rows_of(back[0]) == rows_of(back[1])
    assert out.where("g is null or g = 'thin'").where("block <> 0 or blocks <> 1").isEmpty()
    found = out.where((F.col("g") == "wide") & (A.block_of(F.lit(3), F.col("blocks")) == F.col("block")))
    assert found.first().amounts[3] == 13
    assert A.pivot_blocks(df.limit(0), ["g"], "k", "v").isEmpty()
