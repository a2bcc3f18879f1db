"""Data checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quern.functions.expressions import tier
from quern.operators import quality as Q
from quern.plans.builds import judge
from quern.queries import frames
from quern.queries.registry import query
from quern.session import new_folder
from quern.sources.tables import SCHEMAS, table


@query("check_not_null", f"SELECT id, name, country FROM {frames.USERS} WHERE email IS NULL")
def check_not_null(spark, sf):
    return Q.not_null(frames.users(spark, sf), "email").select("id", "name", "country")


@query(
    "check_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_unique(spark, sf):
    return Q.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_accepted_values", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def check_accepted_values(spark, sf):
    return Q.accepted_values(table(spark, sf, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


@query(
    "check_relationships",
    """SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id
    AND c.c_mktsegment <> 'MACHINERY')""",
)
def check_relationships(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    return Q.relationships(events, "user_id", table(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'"), "c_custkey")


@query("check_singular", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'")
def check_singular(spark, sf):
    def dated_after(orders):
        return orders.where("o_orderdate > timestamp_ntz'2001-01-01 00:00:00'").select("o_orderkey", "o_orderdate")

    return Q.singular(dated_after, table(spark, sf, "orders"))


@query(
    "check_positive",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <= 0",
)
def check_positive(spark, sf):
    return Q.is_positive(table(spark, sf, "lineitem"), "l_discount").select("l_orderkey", "l_linenumber", "l_discount")


@query("check_between", "SELECT p_partkey, p_size FROM part WHERE p_size < 5 OR p_size > 45")
def check_between(spark, sf):
    return Q.is_between(table(spark, sf, "part"), "p_size", 5, 45).select("p_partkey", "p_size")


@query(
    "check_severity",
    """SELECT count(*) AS failures, CASE WHEN count(*) > 50 THEN 'error' WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END
    AS status FROM orders WHERE o_totalprice > 499900""",
)
def check_severity(spark, sf):
    high = table(spark, sf, "orders").where("o_totalprice > 499900")
    return Q.verdict(high, "warn", (">", 0), (">", 50))


@query("check_store_failures", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 500")
def check_store_failures(spark, sf):
    poor = table(spark, sf, "customer").where("c_acctbal < 500").select("c_custkey", "c_acctbal")
    return Q.store_failures(poor, "low_balance", new_folder(spark, "audit"))


@query(
    "check_unit_test",
    """SELECT order_id, tier AS order_tier, side, 1::BIGINT AS copies FROM (
    SELECT o_orderkey AS order_id, CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 100000 THEN 'medium'
    ELSE 'low' END AS want, CASE WHEN o_totalprice >= 250000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'medium'
    ELSE 'low' END AS got FROM orders) t, LATERAL (VALUES (want, 'missing'), (got, 'unexpected')) v(tier, side)
    WHERE want <> got""",
)
def check_unit_test(spark, sf):
    # The expectation is written another way, and with another threshold: the differences are the rows between them.
    def logic(orders):
        return orders.withColumn("order_tier", tier("amount", [(250000, "high"), (100000, "medium")], "low"))

    given = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"))
    label = F.element_at(F.array(F.lit("low"), F.lit("medium"), F.lit("high")),
                         1 + (F.col("amount") > 100000).cast("int") + (F.col("amount") > 200000).cast("int"))
    return Q.unit_test(logic, [given], given.select("order_id", label.alias("order_tier")))


@query(
    "check_freshness",
    """SELECT max(o_orderdate) AS max_loaded_at, date_diff('second', max(o_orderdate), TIMESTAMP '2001-08-02 12:00:00')
    AS age_seconds, CASE WHEN date_diff('second', max(o_orderdate), TIMESTAMP '2001-08-02 12:00:00') > 172800 THEN 'error'
    WHEN date_diff('second', max(o_orderdate), TIMESTAMP '2001-08-02 12:00:00') > 86400 THEN 'warn' ELSE 'pass' END
    AS status FROM orders""",
)
def check_freshness(spark, sf):
    return Q.freshness(table(spark, sf, "orders"), "o_orderdate", 24, 48, dt.datetime(2001, 8, 2, 12, 0))


@query("check_contract", "SELECT c_mktsegment, count(*) AS row_count FROM customer GROUP BY c_mktsegment")
def check_contract(spark, sf):
    declared = spark.createDataFrame([], SCHEMAS["customer"]).schema
    accepted = Q.enforce_contract(table(spark, sf, "customer"), declared)
    return accepted.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "check_verdicts",
    """SELECT model, CASE max(r) WHEN 1 THEN 'pass' WHEN 2 THEN 'warn' ELSE 'error' END AS status, count(*) AS checks,
    count(*) FILTER (r > 1) AS not_passed FROM (
    SELECT 'orders' AS model, CASE WHEN count(*) > 0 THEN 3 ELSE 1 END AS r FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT 'orders', CASE WHEN count(*) > 0 THEN 3 ELSE 1 END FROM orders WHERE o_orderkey IS NULL
    UNION ALL SELECT 'part', CASE WHEN count(*) > 0 THEN 2 ELSE 1 END FROM part WHERE p_size > 45) GROUP BY model""",
)
def check_verdicts(spark, sf):
    on_orders = judge(
        table(spark, sf, "orders"),
        {
            "status": (lambda df: Q.accepted_values(df, "o_orderstatus", ["F", "O"]),),
            "key": (lambda df: Q.not_null(df, "o_orderkey"),),
        },
        "orders",
    )
    on_part = judge(table(spark, sf, "part"), {"size": (lambda df: Q.is_between(df, "p_size", max_val=45), "warn")}, "part")
    return Q.roll_up(on_orders.unionByName(on_part))


@query(
    "check_suite",
    """SELECT "check", failures, CASE WHEN failures = 0 THEN 'pass' WHEN "check" = 'size_range' THEN 'warn' ELSE 'error' END
    AS status FROM (SELECT 'key_present' AS "check", count(*) AS failures FROM lineitem WHERE l_orderkey IS NULL
    UNION ALL SELECT 'flag_known', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
    UNION ALL SELECT 'price_positive', count(*) FROM lineitem WHERE l_extendedprice <= 0
    UNION ALL SELECT 'size_range', count(*) FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45
    UNION ALL SELECT 'line_unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))""",
)
def check_suite(spark, sf):
    checks = [
        Q.Check("key_present", "not_null", ("l_orderkey",)),
        Q.Check("flag_known", "accepted_values", ("l_returnflag",), {"values": ["A", "N"]}),
        Q.Check("price_positive", "positive", ("l_extendedprice",)),
        Q.Check("size_range", "between", ("l_quantity",), {"min_val": 5, "max_val": 45}, severity="warn"),
        Q.Check("line_unique", "unique", ("l_orderkey", "l_linenumber")),
    ]
    return Q.run_suite(table(spark, sf, "lineitem"), checks)
