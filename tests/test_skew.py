"""Window functions and joins with a group too large for one task: the results equal the plain ones."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators import joins as J
from quern.operators import skew
from quern.operators import windows as W
from quern.operators.skew import broadcast_if_small, small_enough, split_hot
from tests.conftest import rows_of

LIMIT = 25


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, another third on null, and many ties in the order column."""
    rnd = random.Random(1)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 40}"
        rows.append((i, key, rnd.randrange(60), rnd.choice([None, rnd.randrange(100)])))
    return spark.createDataFrame(rows, "id int, k string, t int, v bigint").repartition(6, "id").cache()


def plain_window(desc=False):
    t = F.col("t").desc() if desc else F.col("t")
    return Window.partitionBy("k").orderBy(t, "id")


def order(desc=False):
    return [("t", "desc"), "id"] if desc else ["t", "id"]


def test_some_groups_are_hot(skewed):
    cold, hot, n = split_hot(skewed, ["k"], LIMIT)
    assert n == 600 and hot.count() == 600 and cold.count() == 300
    assert split_hot(skewed, ["k"], 10_000)[1] is None


@pytest.mark.parametrize("desc", [False, True])
def test_row_number(skewed, desc):
    want = skewed.withColumn("n", F.row_number().over(plain_window(desc)).cast("bigint"))
    assert rows_of(W.add_row_number(skewed, ["k"], order(desc), "n", LIMIT)) == rows_of(want)


@pytest.mark.parametrize("desc", [False, True])
def test_running_sum(skewed, desc):
    w = plain_window(desc).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("s", F.sum("v").over(w))
    assert rows_of(W.add_running_sum(skewed, ["k"], order(desc), "v", "s", LIMIT)) == rows_of(want)


def test_running_sum_of_decimals_keeps_its_type(skewed):
    money = skewed.withColumn("v", (F.col("v") / 7).cast("decimal(18,2)"))
    want = money.withColumn("s", F.sum("v").over(plain_window().rowsBetween(Window.unboundedPreceding, 0)))
    got = W.add_running_sum(money, ["k"], order(), "v", "s", LIMIT)
    assert got.schema["s"].dataType == want.schema["s"].dataType and rows_of(got) == rows_of(want)


@pytest.mark.parametrize("n", [1, 3])
def test_neighbours(skewed, n):
    w = plain_window()
    want = skewed.withColumn("p", F.lag("v", n).over(w)).withColumn("q", F.lead("v", n).over(w))
    assert rows_of(W.add_neighbours(skewed, ["k"], order(), "v", n, ("p", "q"), LIMIT)) == rows_of(want)


@pytest.mark.parametrize("item", ["t", ("t", "desc"), "v"])
def test_ranks_with_ties(skewed, item):
    sort = F.col("t").desc() if isinstance(item, tuple) else F.col(item)
    w = Window.partitionBy("k").orderBy(sort)
    want = skewed.withColumn("r", F.rank().over(w).cast("bigint")).withColumn("d", F.dense_rank().over(w).cast("bigint"))
    assert rows_of(W.add_ranks(skewed, ["k"], [item], ("r", "d"), LIMIT)) == rows_of(want)


def test_carry_forward(skewed):
    w = plain_window().rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("f", F.last("v", ignorenulls=True).over(w))
    assert rows_of(W.carry_forward(skewed, ["k"], order(), "v", "f", LIMIT)) == rows_of(want)


def test_latest_per_key(skewed):
    newest = skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("t"), F.desc("id"))))
    assert rows_of(W.latest_per_key(skewed, ["k"], ["t", "id"])) == rows_of(newest.where("n = 1").drop("n"))


@pytest.mark.parametrize("n, limit", [(4, LIMIT), (None, LIMIT), (None, 10_000)])
def test_salted_join_equals_plain_join(spark, skewed, n, limit):
    dim = spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3), ("unused", 4)], "k string, label int")
    want = skewed.join(dim, "k")
    assert rows_of(J.join_salted(skewed, dim, "k", ["id"], n, limit), *want.columns) == rows_of(want)


def test_salts_spread_the_hot_key_only(spark, skewed):
    dim = spark.createDataFrame([("hot", 1), ("k2", 2)], "k string, label int")
    fact, copied = J.salt_pair(skewed, dim, ["k"], ["id"], limit=LIMIT)
    # 300 rows over a limit of 25 make 12 parts.
    assert rows_of(copied.groupBy("k").count()) == [("hot", 12), ("k2", 1)]
    assert fact.where("k = 'hot'").select("__salt").distinct().count() == 12
    assert rows_of(fact.where("k <> 'hot' or k is null").select("__salt").distinct()) == [(0,)]


def history(spark):
    rows = []
    for key in ["hot", "k2", "k5", None]:
        at = 0
        for i in range(30):
            start, at = at, at + 1 + i % 4
            if i % 7 != 3:  # leaves gaps
                rows.append((key, f"{key}-{i}", start, None if i == 29 else at))
    rows.append(("k2", "empty", 5, 5))
    return spark.createDataFrame(rows, "k string, plan string, valid_from int, valid_to int")


@pytest.mark.parametrize("limit", [None, LIMIT])
def test_point_in_time_join_equals_range_join(spark, skewed, limit):
    fact = skewed.withColumn("at", F.when(F.col("id") % 50 != 0, F.col("t"))).select("id", "k", "at")
    hist = history(spark)
    h = hist.alias("h")
    valid = (F.col("at") >= F.col("h.valid_from")) & (F.col("h.valid_to").isNull() | (F.col("at") < F.col("h.valid_to")))
    want = fact.alias("f").join(h, (F.col("f.k") == F.col("h.k")) & valid, "left").select(
        "id", "f.k", "at", "plan", "valid_from", "valid_to"
    )
    assert want.count() == fact.count()
    got = J.join_point_in_time(fact, hist, ["k"], "at", "valid_from", "valid_to", limit)
    assert rows_of(got) == rows_of(want)


def test_time_range_join_equals_brute_force(spark):
    rnd = random.Random(2)
    start = dt.datetime(1969, 12, 31, 23, 0)

    def side(n):
        return [(i, rnd.choice("ab"), start + dt.timedelta(seconds=rnd.randrange(20_000))) for i in range(n)]

    left, right = side(120), side(120) + [(900, "a", start), (901, "a", start + dt.timedelta(seconds=600))]
    left.append((800, "a", start))
    a = spark.createDataFrame(left, "a_id int, k string, t1 timestamp_ntz")
    b = spark.createDataFrame(right, "b_id int, k string, t2 timestamp_ntz")
    want = sorted(
        (x[0], y[0]) for x in left for y in right
        if x[1] == y[1] and x[2] <= y[2] <= x[2] + dt.timedelta(seconds=600)
    )
    got = sorted(tuple(r) for r in J.join_within(a, b, ["k"], "t1", "t2", 600).select("a_id", "b_id").collect())
    assert got == want and (800, 900) in got and (800, 901) in got


def test_broadcast_needs_a_small_side(spark):
    assert small_enough(spark.range(10))
    assert not small_enough(spark.range(11), rows=10)
    assert not small_enough(spark.range(100).select(F.repeat(F.lit("x"), 100).alias("s")), size=5000)
    plan = spark.range(5).join(broadcast_if_small(spark.range(1000), rows=10), "id")
    assert "ResolvedHint" not in plan._jdf.queryExecution().analyzed().toString()


def many_groups(spark, n=400, each=15):
    """Groups just over a limit of 10, with rows that come twice, null keys and null values."""
    rows = [(i % n or None, i // n % 5, i // 2, None if i % 7 == 0 else i) for i in range(n * each)]
    return spark.createDataFrame(rows + rows[:40], "k int, t int, id int, v bigint").repartition(4, "id")


def most_tasks(spark, work):
    """The result of `work` and the largest number of tasks in one of its stages."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, group)
    out = work()
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return out, max(info.numTasks for info in map(tracker.getStageInfo, stages) if info)


def test_neighbours_of_many_groups_over_a_small_limit_make_few_tasks(spark):
    df = many_groups(spark)
    w = Window.partitionBy("k").orderBy("t", "id", "v")
    want = df.withColumn("p", F.lag("v").over(w)).withColumn("q", F.lead("v").over(w))
    got, tasks = most_tasks(spark, lambda: rows_of(W.add_neighbours(df, ["k"], ["t", "id", "v"], "v", 1, ("p", "q"), 10)))
    assert got == rows_of(want) and tasks <= 200


def test_row_numbers_of_many_groups_over_a_small_limit_make_few_tasks(spark):
    df = many_groups(spark)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "id", "v")).cast("bigint"))
    got, tasks = most_tasks(spark, lambda: rows_of(W.add_row_number(df, ["k"], ["t", "id", "v"], "n", 10)))
    assert got == rows_of(want) and tasks <= 200


def test_only_groups_that_go_on_into_a_range_are_carried(spark):
    # Three ranges cut at most two of the 400 groups.
    carried = []
    broadcast = F.broadcast
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(W.F, "broadcast", lambda df: carried.append(df) or broadcast(df))
        patch.setattr(W, "RANGES", 3, raising=False)
        df = many_groups(spark)
        got = rows_of(W.add_row_number(df, ["k"], ["t", "id", "v"], "n", 10))
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "id", "v")).cast("bigint"))
    assert got == rows_of(want) and 0 < carried[-1].count() <= 2


def test_a_long_list_of_hot_keys_is_not_broadcast(spark, skewed, monkeypatch):
    monkeypatch.setattr(skew, "small_enough", lambda df, rows, size: False)
    cold, hot, n = split_hot(skewed, ["k"], LIMIT)
    assert n == 600 and hot.count() == 600 and cold.count() == 300
    for part in (cold, hot):
        assert "ResolvedHint" not in part._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("n", [0, 2, 60, 1000])
def test_neighbours_some_ranges_away(spark, skewed, monkeypatch, n, small):
    if not small:
        monkeypatch.setattr(W, "small_enough", lambda df: False)
    w = plain_window()
    want = skewed.withColumn("p", F.lag("v", n).over(w)).withColumn("q", F.lead("v", n).over(w))
    assert rows_of(W.add_neighbours(skewed, ["k"], order(), "v", n, ("p", "q"), LIMIT)) == rows_of(want)


def test_ranges_stay_within_the_limit_of_a_task():
    assert W._range_count(600, LIMIT) == 24 and W._range_count(1, LIMIT) == 2
    assert W._range_count(9_000_000, 10) == W.RANGES
    assert W._range_count(3_000 * W.GROUP_LIMIT, 10) == 3_000 == W._range_count(3_000 * W.GROUP_LIMIT, W.GROUP_LIMIT)
