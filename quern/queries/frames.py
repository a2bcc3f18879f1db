"""The driver's tables in the roles that the operators' examples use, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.expressions import MONEY, money
from quern.operators.windows import add_neighbours
from quern.sources.tables import SCHEMAS, table
from quern.streaming.streams import read_stream

# Tables in use at the shop: orders, customers, payments, items. Order status F stands for paid or completed, O for
# pending, P for refunded or cancelled; the codes are kept, so that filters on them reach the scan.
DONE, CANCELLED = "F", "P"


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


RAW_ORDERS = """(SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
    o_orderstatus AS status, o_orderdate AS created_at FROM orders)"""


def lab_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


LAB_ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
    o_orderstatus AS status, o_orderdate AS created_at FROM orders)"""


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with the name of their nation (a table of 25 rows at any scale); every tenth has no email."""
    nation = F.broadcast(table(spark, sf, "nation"))
    email = F.concat(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")), F.lit("@Example.com"))
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_custkey") % 10 != 0, email).alias("email"),
            F.col("n_name").alias("country"),
        )
    )


USERS = """(SELECT c_custkey AS id, c_name AS name,
    CASE WHEN c_custkey % 10 <> 0 THEN replace(c_name, '#', '.') || '@Example.com' END AS email,
    n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def payments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_cents"),
        F.col("o_orderdate").alias("created_at"),
    )


PAYMENTS = """(SELECT o_orderkey AS id, o_custkey AS order_id, o_orderpriority AS payment_method,
    CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents, o_orderdate AS created_at FROM orders)"""

# The payment methods of the driver's orders.
METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("decimal(10,0)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("unit_price"),
    )


ORDER_ITEMS = """(SELECT l_orderkey AS order_id, l_partkey AS product_id,
    CAST(l_quantity AS DECIMAL(10,0)) AS quantity, CAST(l_extendedprice AS DECIMAL(14,2)) AS unit_price
    FROM lineitem)"""


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Items with their order's customer, status and time."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return (
        table(spark, sf, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("product_id"),
            money("l_extendedprice").alias("amount"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").alias("created_at"),
        )
    )


ORDER_LINES = """(SELECT l_orderkey AS order_id, l_linenumber AS line, o_custkey AS user_id, l_partkey AS product_id,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS status, o_orderdate AS created_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category")
    )


PRODUCTS = "(SELECT p_partkey AS product_id, p_name AS name, p_type AS category FROM part)"


def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales per supplier and ship date."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("store_id"), F.col("l_shipdate").alias("date"))
        .agg(F.sum(money("l_extendedprice")).cast(MONEY).alias("sales_amount"))
    )


DAILY_SALES = """(SELECT l_suppkey AS store_id, l_shipdate AS date,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS sales_amount
    FROM lineitem GROUP BY l_suppkey, l_shipdate)"""

# Events


def app_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "user_id", F.col("event_type").alias("event_name"), F.col("ts").alias("event_timestamp")
    )


APP_EVENTS = "(SELECT event_id, user_id, event_type AS event_name, ts AS event_timestamp FROM events)"


def web_logs(spark: SparkSession, sf: str) -> DataFrame:
    code = (
        F.when(F.col("event_type") == "error", 500)
        .when(F.col("event_type") == "signup", 404)
        .when(F.col("event_type") == "view", 302)
        .otherwise(200)
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("log_id"),
        F.col("user_id"),
        code.alias("status_code"),
        F.col("event_type").alias("endpoint"),
        money("value").alias("response_ms"),
    )


WEB_LOGS = """(SELECT event_id AS log_id, user_id, CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404
    WHEN 'view' THEN 302 ELSE 200 END AS status_code, event_type AS endpoint,
    CAST(value AS DECIMAL(18,2)) AS response_ms FROM events)"""


def event_feed(spark: SparkSession, sf: str, files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a stream. The pattern fits one file as well as a folder of files."""
    return read_stream(spark, f"{sf}/events*.parquet", SCHEMAS["events"], files_per_trigger=files_per_trigger)


# Subscriptions in two states: every 7th changes plan, every 11th is new, every 13th is gone


def subscriptions(spark: SparkSession, sf: str, state: int) -> DataFrame:
    base = table(spark, sf, "customer")
    key = F.col("c_custkey")
    moved = (key % 7 == 0) if state == 2 else F.lit(False)
    return base.where(key % 11 != 0 if state == 1 else key % 13 != 0).select(
        key.alias("id"),
        key.alias("customer_id"),
        F.when(moved, F.concat("c_mktsegment", F.lit("+"))).otherwise(F.col("c_mktsegment")).alias("plan"),
        F.lit("active").alias("status"),
        F.when(moved, F.lit("2024-03-01 00:00:00"))
        .otherwise(F.lit("2024-01-01 00:00:00"))
        .cast("timestamp_ntz")
        .alias("updated_at"),
    )


SUBSCRIPTIONS_1 = """(SELECT c_custkey AS id, c_custkey AS customer_id, c_mktsegment AS plan, 'active' AS status,
    TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM customer WHERE c_custkey % 11 <> 0)"""
SUBSCRIPTIONS_2 = """(SELECT c_custkey AS id, c_custkey AS customer_id,
    CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment || '+' ELSE c_mktsegment END AS plan, 'active' AS status,
    CASE WHEN c_custkey % 7 = 0 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END
    AS updated_at FROM customer WHERE c_custkey % 13 <> 0)"""


# Lineage: an order leads to the same customer's next one; every fifth customer's last leads back to the first


def order_edges(spark: SparkSession, sf: str, cycles: bool = False) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    chained = add_neighbours(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey")
    edges = chained.where("next is not null").select(
        F.col("o_orderkey").alias("source"), F.col("next").alias("target")
    )
    if not cycles:
        return edges
    at = F.struct("o_orderdate", "o_orderkey")
    ends = (
        orders.where("o_custkey % 5 = 0")
        .groupBy("o_custkey")
        .agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .select(F.col("last.o_orderkey").alias("source"), F.col("first.o_orderkey").alias("target"))
    )
    return edges.unionByName(ends)


ORDER_EDGES = """(SELECT source, target FROM (SELECT o_orderkey AS source, lead(o_orderkey) OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS target FROM orders) WHERE target IS NOT NULL)"""
