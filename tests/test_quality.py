import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import types as T

from quern.functions.expressions import tier
from quern.operators import quality as Q
from tests import data
from tests.conftest import rows_of


def dirty_orders(spark):
    schema, rows = data.RAW_ORDERS
    rows = [(*r[:3], "cancelled", r[4]) if r[0] == 105 else r for r in rows]
    return spark.createDataFrame(rows + [(107, 1, D("25.00"), "paid", dt.date(2099, 1, 1))], schema)


def test_violations_found(spark):
    orders = dirty_orders(spark)
    assert rows_of(Q.accepted_values(orders, "status", ["paid", "refunded", "pending"]), "id") == [(105,)]
    future = Q.singular(lambda o: o.where("created_at > date'2024-12-31'"), orders)
    assert rows_of(future, "id") == [(107,)]
    users = data.frame(spark, data.DIRTY_USERS)
    assert rows_of(Q.not_null(users, "email"), "id") == [(2,), (6,)]


def test_clean_rows_pass(spark):
    orders = data.frame(spark, data.RAW_ORDERS)
    assert Q.accepted_values(orders, "status", ["paid", "refunded", "pending"]).isEmpty()
    assert Q.unique(orders, ["id"]).isEmpty()
    assert rows_of(Q.unique(orders, ["customer_id"])) == [(1, 2), (2, 2)]


def test_nulls_pass_value_checks(spark):
    child = spark.createDataFrame([(1, "a"), (None, None), (None, None), (9, "z")], "k bigint, v string")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id bigint")
    assert rows_of(Q.relationships(child, "k", parent, "id"), "k") == [(9,)]
    assert Q.unique(child, ["k"]).isEmpty()
    assert rows_of(Q.accepted_values(child, "v", ["a"]), "v") == [("z",)]
    assert Q.is_positive(child, "k").isEmpty()


def test_values_compared_as_text(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows_of(Q.accepted_values(df, "k", ["1", 2])) == [(3,)]


def test_bounds_are_allowed(spark):
    df = spark.range(10)
    assert rows_of(Q.is_between(df, "id", 2, 7)) == [(0,), (1,), (8,), (9,)]
    assert rows_of(Q.is_between(df, "id", min_val=8)) == [(i,) for i in range(8)]
    assert Q.is_between(df, "id").isEmpty()


@pytest.mark.parametrize(
    "rows, rule, want",
    [
        (0, ("error",), "pass"),
        (1, ("error",), "error"),
        (9, ("warn",), "warn"),
        (2, ("warn", (">", 0), (">", 50)), "warn"),
        (51, ("warn", (">", 0), (">", 50)), "error"),
        (3, ("error", (">", 5), (">", 10)), "pass"),
        (7, ("error", (">=", 5), ("=", 10)), "warn"),
    ],
)
def test_severity(spark, rows, rule, want):
    assert rows_of(Q.verdict(spark.range(rows), *rule)) == [(rows, want)]


def test_high_value_orders_warn(spark):
    high = data.frame(spark, data.RAW_ORDERS).where("amount > 50")
    assert rows_of(Q.verdict(high, "warn", (">", 0), (">", 50))) == [(2, "warn")]


def test_failures_are_stored_and_replaced(spark, folder):
    path = folder()
    users = data.frame(spark, data.DIRTY_USERS)
    assert Q.store_failures(Q.not_null(users, "email"), "email", path).count() == 2
    assert Q.store_failures(Q.not_null(users, "name"), "name", path).count() == 1
    assert Q.store_failures(Q.not_null(users, "id"), "email", path).count() == 0
    assert spark.read.parquet(f"{path}/name").count() == 1


def test_unit_test_compares_named_columns(spark):
    def logic(orders):
        return orders.withColumnRenamed("id", "order_id").withColumn(
            "order_tier", tier("amount", [(50, "high"), (20, "medium")], "low")
        )

    given = Q.mock_rows(spark, [(1, 60.0), (2, 25.0), (3, 10.0)], "id bigint, amount double")
    schema = "order_id bigint, order_tier string"
    good = Q.mock_rows(spark, [(1, "high"), (2, "medium"), (3, "low")], schema)
    assert Q.unit_test(logic, [given], good).isEmpty()
    bad = Q.mock_rows(spark, [(1, "high"), (2, "high"), (3, "low")], schema)
    assert rows_of(Q.unit_test(logic, [given], bad)) == [(2, "high", "missing", 1), (2, "medium", "unexpected", 1)]


@pytest.mark.parametrize("hours, want", [(24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, want):
    loaded = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(loaded,), (loaded - dt.timedelta(days=9),)], "at timestamp_ntz")
    row = Q.freshness(df, "at", 24, 48, loaded + dt.timedelta(hours=hours)).first()
    assert (row.age_seconds, row.status) == (hours * 3600, want)
    assert Q.freshness(df.where("false"), "at", 24, 48, loaded).first().status == "error"


def test_contract(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id bigint, name string, extra double")
    want = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.IntegerType()), T.StructField("at", T.DateType())])
    assert rows_of(Q.contract(df, want), "column", "problem") == [("at", "missing"), ("extra", "undeclared"), ("id", "type")]
    with pytest.raises(ValueError, match="at: missing"):
        Q.enforce_contract(df, want)
    same = T.StructType([df.schema["name"], df.schema["extra"], df.schema["id"]])
    assert Q.enforce_contract(df, same).columns == ["name", "extra", "id"]


def test_roll_up_takes_the_worst(spark):
    rows = [("a", "pass"), ("a", "warn"), ("b", "pass"), ("c", "warn"), ("c", "error")]
    out = Q.roll_up(spark.createDataFrame(rows, "model string, status string"))
    assert rows_of(out) == [("a", "warn", 2, 1), ("b", "pass", 1, 0), ("c", "error", 2, 2)]


def test_suite_equals_single_checks(spark):
    df = spark.createDataFrame(
        [(1, "x", 5), (1, "y", -1), (None, None, None), (3, "x", 99)], "k int, v string, n int"
    )
    checks = [
        Q.Check("k_set", "not_null", ("k",)),
        Q.Check("k_unique", "unique", ("k",)),
        Q.Check("v_known", "accepted_values", ("v",), {"values": ["x"]}, severity="warn"),
        Q.Check("n_positive", "positive", ("n",)),
        Q.Check("n_range", "between", ("n",), {"min_val": 0, "max_val": 100}, error_if=(">", 1)),
    ]
    singles = {
        "k_set": Q.not_null(df, "k"), "k_unique": Q.unique(df, ["k"]), "v_known": Q.accepted_values(df, "v", ["x"]),
        "n_positive": Q.is_positive(df, "n"), "n_range": Q.is_between(df, "n", 0, 100),
    }
    got = {r.check: (r.failures, r.status) for r in Q.run_suite(df, checks).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v.count() for k, v in singles.items()}
    assert got["v_known"][1] == "warn" and got["k_set"][1] == "error" and got["n_range"][1] == "warn"
    plan = Q.run_suite(df, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2  # one scan for the row checks, one for the key
