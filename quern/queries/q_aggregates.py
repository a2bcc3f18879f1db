"""Aggregations, pivots, metrics, window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import aggregates as A
from quern.operators import windows as W
from quern.functions.expressions import money
from quern.operators.joins import join_small
from quern.operators.rows import sort_by, where_equal
from quern.plans.metrics import SemanticModel, metric
from quern.queries import frames
from quern.queries.registry import plain, query
from quern.sources.rows import sql
from quern.sources.tables import table


@query("agg_count_by", "SELECT l_returnflag, l_linestatus, count(*) AS row_count FROM lineitem GROUP BY 1, 2")
def agg_count_by(spark, sf):
    return A.count_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(
    "agg_multi_metric",
    f"""SELECT user_id, count(order_id) AS total_orders, CAST(sum(amount) AS DOUBLE) AS total_spent,
    CAST(sum(amount) AS DOUBLE) / CAST(count(amount) AS DOUBLE) AS avg_order, CAST(min(amount) AS DOUBLE) AS min_order,
    CAST(max(amount) AS DOUBLE) AS max_order FROM {frames.LAB_ORDERS} WHERE status = 'F' GROUP BY user_id""",
)
def agg_multi_metric(spark, sf):
    completed = where_equal(frames.lab_orders(spark, sf), "status", frames.DONE)
    aggs = [
        F.count("order_id").alias("total_orders"), F.sum("amount").alias("total_spent"), A.mean("amount").alias("avg_order"),
        F.min("amount").alias("min_order"), F.max("amount").alias("max_order"),
    ]
    return plain(sort_by(A.summarise(completed, ["user_id"], aggs), [("total_spent", "desc"), "user_id"]))


@query(
    "agg_sum_mart",
    f"SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS revenue FROM {frames.RAW_ORDERS} WHERE status = 'F' GROUP BY customer_id",
)
def agg_sum_mart(spark, sf):
    return plain(A.sum_by(where_equal(frames.raw_orders(spark, sf), "status", frames.DONE), ["customer_id"], "amount", "revenue"))


@query(
    "agg_sql_avg",
    """SELECT p_brand, count(*) AS total_parts, round(avg(p_size), 1) AS avg_size FROM part WHERE p_size >= 25
    GROUP BY p_brand ORDER BY total_parts DESC""",
)
def agg_sql_avg(spark, sf):
    return sql(
        spark,
        """SELECT p_brand, count(*) AS total_parts, round(avg(p_size), 1) AS avg_size FROM {parts} WHERE p_size >= 25
        GROUP BY p_brand ORDER BY total_parts DESC""",
        {"parts": table(spark, sf, "part")},
    )


@query(
    "agg_by_method",
    f"""SELECT payment_method, count(*) AS row_count, CAST(sum(amount_cents) AS BIGINT) AS total FROM {frames.PAYMENTS}
    GROUP BY payment_method""",
)
def agg_by_method(spark, sf):
    return A.count_and_sum(frames.payments(spark, sf), ["payment_method"], "amount_cents")


@query("agg_global", "SELECT count(*) AS row_count FROM lineitem")
def agg_global(spark, sf):
    return A.row_count(table(spark, sf, "lineitem"))


PIVOT = f"""SELECT order_id, {', '.join(f"CAST(sum(CASE WHEN payment_method = '{m}' THEN amount_cents ELSE 0 END) AS BIGINT) AS \"{m}_amount\"" for m in frames.METHODS)}
    FROM {frames.PAYMENTS} GROUP BY order_id"""


@query("pivot_fixed", PIVOT)
def pivot_fixed(spark, sf):
    return A.pivot_sum(frames.payments(spark, sf), ["order_id"], "payment_method", "amount_cents", frames.METHODS)


@query(
    "pivot_discovered",
    f"""SELECT order_id, string_agg(payment_method || '=' || total, ';' ORDER BY payment_method) AS amounts FROM (
    SELECT order_id, payment_method, CAST(sum(amount_cents) AS BIGINT) AS total FROM {frames.PAYMENTS} GROUP BY 1, 2)
    GROUP BY order_id""",
)
def pivot_discovered(spark, sf):
    wide = A.pivot_map(frames.payments(spark, sf), ["order_id"], "payment_method", "amount_cents")
    entry = F.transform(F.map_entries("amounts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return wide.select("order_id", F.array_join(entry, ";").alias("amounts"))


@query(
    "pivot_in_blocks",
    """SELECT l_returnflag, l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, true AS in_its_block
    FROM lineitem GROUP BY 1, 2""",
)
def pivot_in_blocks(spark, sf):
    """Quantities per supplier, three groups of very many values, read back from their blocks."""
    lines = table(spark, sf, "lineitem").withColumn("quantity", F.col("l_quantity").cast("bigint"))
    wide = A.pivot_blocks(lines, ["l_returnflag"], "l_suppkey", "quantity", size=25)
    values = wide.select("l_returnflag", "block", "blocks", F.explode("amounts").alias("l_suppkey", "quantity"))
    right = A.block_of(F.col("l_suppkey"), F.col("blocks")) == F.col("block")
    return values.select("l_returnflag", "l_suppkey", "quantity", right.alias("in_its_block"))


@query("agg_high_watermark", "SELECT max(ts) AS high_watermark FROM events")
def agg_high_watermark(spark, sf):
    return A.high_watermark(table(spark, sf, "events"), "ts")


@query(
    "agg_latency",
    f"""SELECT endpoint, count(*) AS hits, CAST(sum(response_ms) AS DOUBLE) / CAST(count(response_ms) AS DOUBLE) AS avg_response
    FROM {frames.WEB_LOGS} GROUP BY endpoint""",
)
def agg_latency(spark, sf):
    return plain(A.latency_summary(frames.web_logs(spark, sf), ["endpoint"], "response_ms"))


@query(
    "agg_country_revenue",
    f"""SELECT country, count(order_id) AS order_count, CAST(sum(amount) AS DOUBLE) AS total_revenue,
    CAST(sum(amount) AS DOUBLE) / CAST(count(amount) AS DOUBLE) AS avg_order_value
    FROM {frames.LAB_ORDERS} o JOIN {frames.USERS} u ON o.user_id = u.id WHERE status = 'F' GROUP BY country""",
)
def agg_country_revenue(spark, sf):
    return plain(A.country_revenue(frames.lab_orders(spark, sf), frames.users(spark, sf), frames.DONE))


@query(
    "semantic_metric",
    f"""SELECT status, date_trunc('month', created_at)::TIMESTAMP AS created_at_month, CAST(sum(amount) AS DOUBLE) AS total_revenue,
    count(order_id) AS order_count FROM {frames.LAB_ORDERS} GROUP BY 1, 2""",
)
def semantic_metric(spark, sf):
    model = SemanticModel(
        frames.lab_orders(spark, sf),
        measures={"total_revenue": ("sum", "amount"), "order_count": ("count", "order_id")},
        categorical=["status"],
        time="created_at",
        entities={"primary": "order_id", "foreign": "user_id"},
    )
    return plain(metric(model, ["total_revenue", "order_count"], ["status"], "month"))


# Window functions. A store has one row per day, so its group is bounded by the calendar.


@query(
    "win_row_number",
    f"""SELECT store_id, date, CAST(sales_amount AS DOUBLE) AS sales_amount,
    row_number() OVER (PARTITION BY store_id ORDER BY date) AS rank_by_date FROM {frames.DAILY_SALES}""",
)
def win_row_number(spark, sf):
    return plain(W.add_row_number(frames.daily_sales(spark, sf), ["store_id"], ["date"], "rank_by_date", None))


@query(
    "win_rank_dense",
    """SELECT o_orderkey, o_orderpriority, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank FROM orders
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate)""",
)
def win_rank_dense(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return W.add_ranks(orders, ["o_orderpriority"], ["o_orderdate"]).drop("o_orderdate")


@query(
    "win_lag_lead",
    f"""SELECT store_id, date, CAST(lag(sales_amount) OVER w AS DOUBLE) AS prev_day_sales,
    CAST(lead(sales_amount) OVER w AS DOUBLE) AS next_day_sales FROM {frames.DAILY_SALES}
    WINDOW w AS (PARTITION BY store_id ORDER BY date)""",
)
def win_lag_lead(spark, sf):
    names = ("prev_day_sales", "next_day_sales")
    sales = frames.daily_sales(spark, sf)
    return plain(W.add_neighbours(sales, ["store_id"], ["date"], "sales_amount", 1, names, None).drop("sales_amount"))


@query(
    "win_running_total",
    f"""SELECT store_id, date, CAST(sum(sales_amount) OVER (PARTITION BY store_id ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM {frames.DAILY_SALES}""",
)
def win_running_total(spark, sf):
    sales = frames.daily_sales(spark, sf)
    return plain(W.add_running_sum(sales, ["store_id"], ["date"], "sales_amount", limit=None).drop("sales_amount"))


# A customer has more than ten orders and fewer than the usual limit, so these take the way of hot groups.
FEW = 10


@query(
    "win_hot_row_number",
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders",
)
def win_hot_row_number(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    numbered = W.add_row_number(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "n", FEW)
    return numbered.select("o_custkey", "o_orderkey", F.col("n").cast("bigint").alias("n"))


@query(
    "win_hot_running_total",
    """SELECT o_custkey, o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
    FROM orders""",
)
def win_hot_running_total(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", money("o_totalprice").alias("price"))
    total = W.add_running_sum(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "price", limit=FEW)
    return plain(total.select("o_custkey", "o_orderkey", "running_total"))


@query(
    "win_hot_neighbours",
    """SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER w AS previous, lead(o_orderkey) OVER w AS next FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def win_hot_neighbours(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return W.add_neighbours(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey", limit=FEW).drop("o_orderdate")


@query(
    "win_rank_of_agg",
    f"""SELECT country, category, CAST(total_revenue AS DOUBLE) AS total_revenue, order_count,
    row_number() OVER (PARTITION BY country ORDER BY total_revenue DESC, category) AS category_rank FROM (
    SELECT u.country, p.category, sum(o.amount) AS total_revenue, count(*) AS order_count FROM {frames.ORDER_LINES} o
    JOIN {frames.USERS} u ON o.user_id = u.id JOIN {frames.PRODUCTS} p ON o.product_id = p.product_id GROUP BY 1, 2)""",
)
def win_rank_of_agg(spark, sf):
    orders = frames.order_lines(spark, sf)
    goods = frames.products(spark, sf).select("product_id", "category")
    people = frames.users(spark, sf).select(F.col("id").alias("user_id"), "country")
    joined = join_small(orders, goods, ["product_id"]).join(people, "user_id")
    return plain(W.rank_totals(joined, "category", "country", "amount"))


@query(
    "dedup_latest",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""",
)
def dedup_latest(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return W.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
