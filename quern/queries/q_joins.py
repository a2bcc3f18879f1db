"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.expressions import money
from quern.operators import joins
from quern.operators.rows import rename_select
from quern.plans.history import VALID_FROM, VALID_TO, snapshot_timestamp
from quern.queries import frames
from quern.queries.registry import plain, query
from quern.session import new_folder
from quern.sources.tables import table
from quern.sources.writers import write_partitioned


@query(
    "join_inner",
    """SELECT c_mktsegment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def join_inner(spark, sf):
    # One row per customer before the join, however many orders a customer has.
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("spent")
    )
    joined = joins.join_on(per_customer, table(spark, sf, "customer"), [("o_custkey", "c_custkey")])
    return plain(joined.groupBy("c_mktsegment").agg(F.sum("n").alias("orders"), F.sum("spent").alias("revenue")))


@query(
    "join_broadcast",
    f"""SELECT o.order_id, o.line, o.product_id, p.name AS product_name, p.category, CAST(o.amount AS DOUBLE) AS amount,
    o.status FROM {frames.ORDER_LINES} o JOIN {frames.PRODUCTS} p ON o.product_id = p.product_id""",
)
def join_broadcast(spark, sf):
    fact = frames.order_lines(spark, sf)
    dim = rename_select(frames.products(spark, sf), {"product_id": "product_id", "product_name": "name", "category": "category"})
    joined = joins.join_small(fact, dim, ["product_id"])
    return plain(joined.select("order_id", "line", "product_id", "product_name", "category", "amount", "status"))


@query(
    "join_sort_merge",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderdate FROM lineitem JOIN orders
    ON l_orderkey = o_orderkey""",
)
def join_sort_merge(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return joins.join_large(items, orders, [("l_orderkey", "o_orderkey")]).drop("o_orderkey")


@query(
    "join_left_agg",
    f"""SELECT o.id AS order_id, o.customer_id, CAST(o.amount AS DOUBLE) AS amount,
    CAST(sum(i.quantity) AS DOUBLE) AS total_items, CAST(sum(i.quantity * i.unit_price) AS DOUBLE) AS calculated_total
    FROM {frames.RAW_ORDERS} o LEFT JOIN {frames.ORDER_ITEMS} i ON o.id = i.order_id
    GROUP BY o.id, o.customer_id, o.amount""",
)
def join_left_agg(spark, sf):
    orders = frames.raw_orders(spark, sf).select(F.col("id").alias("order_id"), "customer_id", "amount")
    total = F.sum(F.col("quantity") * F.col("unit_price"))
    sums = [F.sum("quantity").alias("total_items"), total.alias("calculated_total")]
    return plain(joins.left_summary(orders, frames.order_items(spark, sf), ["order_id"], sums))


@query(
    "join_multiway",
    f"""SELECT o.order_id, o.line, u.name AS customer_name, u.country, p.name AS product_name, p.category,
    CAST(o.amount AS DOUBLE) AS amount FROM {frames.ORDER_LINES} o JOIN {frames.USERS} u ON o.user_id = u.id
    LEFT JOIN (SELECT * FROM {frames.PRODUCTS} WHERE product_id % 9 <> 0) p ON o.product_id = p.product_id""",
)
def join_multiway(spark, sf):
    fact = frames.order_lines(spark, sf).alias("o")
    people = frames.users(spark, sf).alias("u")
    goods = joins.broadcast_if_small(frames.products(spark, sf).where("product_id % 9 <> 0")).alias("p")
    joined = joins.join_many(
        fact,
        [(people, F.col("o.user_id") == F.col("u.id"), "inner"),
         (goods, F.col("o.product_id") == F.col("p.product_id"), "left")],
    )
    return plain(
        joined.select(
            "o.order_id", "o.line", F.col("u.name").alias("customer_name"), "u.country", F.col("p.name").alias("product_name"),
            "p.category", "o.amount",
        )
    )


PLAN_HISTORY = f"""(SELECT coalesce(b.id, a.id) AS customer_id, coalesce(a.plan, b.plan) AS plan,
    coalesce(a.updated_at, b.updated_at) AS valid_from,
    CASE WHEN a.id IS NOT NULL AND b.updated_at > a.updated_at THEN b.updated_at END AS valid_to
    FROM {frames.SUBSCRIPTIONS_1} a FULL JOIN {frames.SUBSCRIPTIONS_2} b ON a.id = b.id UNION ALL
    SELECT b.id, b.plan, b.updated_at, NULL FROM {frames.SUBSCRIPTIONS_1} a JOIN {frames.SUBSCRIPTIONS_2} b
    ON a.id = b.id AND b.updated_at > a.updated_at)"""


@query(
    "join_point_in_time",
    f"""SELECT o.o_orderkey, o.customer_id, o.at, h.plan FROM (SELECT o_orderkey, o_custkey AS customer_id,
    o_orderdate + INTERVAL 8400 DAY AS at FROM orders) o
    LEFT JOIN {PLAN_HISTORY} h ON o.customer_id = h.customer_id AND o.at >= h.valid_from
    AND (o.at < h.valid_to OR h.valid_to IS NULL)""",
)
def join_point_in_time(spark, sf):
    first = snapshot_timestamp(None, frames.subscriptions(spark, sf, 1), "id", "updated_at")
    hist = snapshot_timestamp(first, frames.subscriptions(spark, sf, 2), "id", "updated_at")
    hist = hist.select("customer_id", "plan", VALID_FROM, VALID_TO)
    # The order dates, moved into the years that the history covers.
    fact = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_orderdate") + F.expr("interval 8400 days")).alias("at"),
    )
    found = joins.join_point_in_time(fact, hist, ["customer_id"], "at", VALID_FROM, VALID_TO)
    return found.select("o_orderkey", "customer_id", "at", "plan")


@query(
    "join_star_pruned",
    """SELECT n_name, l_orderkey, l_linenumber, l_extendedprice FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 2""",
)
def join_star_pruned(spark, sf):
    suppliers = joins.broadcast_if_small(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    )
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey")
    fact = write_partitioned(items.join(suppliers, "l_suppkey"), new_folder(spark, "star"), ["n_nationkey"])
    joined = joins.star_join(fact, table(spark, sf, "nation"), "n_nationkey", "n_regionkey = 2")
    return joined.select("n_name", "l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "join_salted",
    """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, c_name AS user_name, c_nationkey
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_salted(spark, sf):
    fact = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("user_id"))
    dim = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"), "c_nationkey")
    return joins.join_salted(fact, dim, "user_id", ["o_orderkey"], limit=20).drop("user_id")


@query("join_anti_orphans", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
    (SELECT c_custkey FROM customer WHERE c_acctbal > 1000)""")
def join_anti_orphans(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return joins.orphans(orders, table(spark, sf, "customer").where("c_acctbal > 1000"), "o_custkey", "c_custkey")


@query(
    "join_range_batch",
    """SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id, v.ts AS view_ts, p.ts AS purchase_ts
    FROM events v JOIN events p ON v.user_id = p.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 1 HOUR
    WHERE v.event_type = 'view' AND p.event_type = 'purchase'""",
)
def join_range_batch(spark, sf):
    events = table(spark, sf, "events")
    views = events.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts"))
    purchases = events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts")
    )
    return joins.join_within(views, purchases, ["user_id"], "view_ts", "purchase_ts", 3600)
