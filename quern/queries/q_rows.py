"""Projections, filters, scalar expressions, sorting, sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quern.functions import expressions as X
from quern.functions.masking import pseudonym
from quern.operators import rows
from quern.queries import frames
from quern.queries.registry import plain, query
from quern.sources.tables import table

# Fixed values of the examples: thresholds, factors, defaults, the secret of the pseudonyms.
ORDER_TIERS = [(200000, "HIGH"), (100000, "MEDIUM")]
DISCOUNT, TAX = "0.9", "0.07"
NO_EMAIL, NO_COUNTRY = "no-reply@company.com", "GLOBAL"
PEPPER = "_pepper_salt"


@query("staging_rename", f"SELECT id AS order_id, customer_id, CAST(amount AS DOUBLE) AS amount, status, created_at FROM {frames.RAW_ORDERS}")
def staging_rename(spark, sf):
    names = {"order_id": "id", "customer_id": "customer_id", "amount": "amount", "status": "status", "created_at": "created_at"}
    return plain(rows.rename_select(frames.raw_orders(spark, sf), names))


@query("select_all", "SELECT * FROM supplier")
def select_all(spark, sf):
    return rows.select_all(table(spark, sf, "supplier"))


@query("filter_equality", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_equality(spark, sf):
    return rows.where_equal(table(spark, sf, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("filter_chain", "SELECT count(*) AS row_count FROM lineitem WHERE l_quantity >= 25 AND l_returnflag <> 'N'")
def filter_chain(spark, sf):
    kept = rows.where_all(table(spark, sf, "lineitem"), [F.col("l_quantity") >= 25, F.col("l_returnflag") != "N"])
    return kept.agg(F.count(F.lit(1)).alias("row_count"))


@query("filter_in_set", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def filter_in_set(spark, sf):
    return rows.where_in(table(spark, sf, "events"), "event_type", ["click", "purchase"]).select("event_id", "event_type")


@query("filter_not_null_range", f"SELECT id, email FROM {frames.USERS} WHERE email IS NOT NULL AND id > 100")
def filter_not_null_range(spark, sf):
    present = rows.where_present(frames.users(spark, sf), "email")
    return rows.where_present(present, "id", above=100).select("id", "email")


@query("filter_as_of_date", "SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-30'")
def filter_as_of_date(spark, sf):
    return rows.where_until(table(spark, sf, "orders"), "o_orderdate", dt.date(1998, 6, 30)).select("o_orderkey", "o_orderdate")


@query("filter_lookback", "SELECT event_id, ts FROM events WHERE ts >= DATE '2024-01-30' - INTERVAL 7 DAY")
def filter_lookback(spark, sf):
    return rows.where_recent(table(spark, sf, "events"), "ts", 7, dt.date(2024, 1, 30)).select("event_id", "ts")


@query("parameter_filter", "SELECT p_partkey, p_size FROM part WHERE p_size >= 10 AND p_type = 'PROMO'")
def parameter_filter(spark, sf):
    return rows.where_param(table(spark, sf, "part"), "p_size >= :low AND p_type = :kind", low=10, kind="PROMO").select(
        "p_partkey", "p_size"
    )


@query(
    "computed_round",
    """SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.9 AS DECIMAL(7,6)), 2) AS DOUBLE) AS discounted,
    CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.07 AS DECIMAL(7,6)), 2) AS DOUBLE) AS tax FROM orders""",
)
def computed_round(spark, sf):
    price = X.money("o_totalprice")
    return plain(
        table(spark, sf, "orders").select(
            "o_orderkey", X.scaled(price, DISCOUNT).alias("discounted"), X.scaled(price, TAX).alias("tax")
        )
    )


@query(
    "case_tier",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 THEN 'HIGH' WHEN o_totalprice >= 100000 THEN 'MEDIUM'
    ELSE 'LOW' END AS order_tier FROM orders""",
)
def case_tier(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.tier("o_totalprice", ORDER_TIERS, "LOW").alias("order_tier"))


@query("boolean_flag", "SELECT event_id, event_type = 'purchase' AS is_purchase FROM events")
def boolean_flag(spark, sf):
    return table(spark, sf, "events").select("event_id", X.flag(F.col("event_type") == "purchase").alias("is_purchase"))


@query("coalesce_default", f"SELECT id, coalesce(email, '{NO_COUNTRY}') AS contact FROM {frames.USERS}")
def coalesce_default(spark, sf):
    return frames.users(spark, sf).select("id", X.default_to("email", value=NO_COUNTRY).alias("contact"))


@query("drop_nulls_subset", f"SELECT id, name, email FROM {frames.USERS} WHERE id IS NOT NULL AND email IS NOT NULL")
def drop_nulls_subset(spark, sf):
    return rows.drop_null_keys(frames.users(spark, sf), ["id", "email"]).select("id", "name", "email")


@query("fill_nulls", f"SELECT id, coalesce(email, '{NO_EMAIL}') AS email, country FROM {frames.USERS}")
def fill_nulls(spark, sf):
    return rows.fill(frames.users(spark, sf), {"email": NO_EMAIL, "country": NO_COUNTRY}).select("id", "email", "country")


@query("lower_text", f"SELECT id, lower(email) AS email_cleaned FROM {frames.USERS}")
def lower_text(spark, sf):
    return frames.users(spark, sf).select("id", X.clean_text("email").alias("email_cleaned"))


@query("to_date_cast", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS row_count FROM events GROUP BY 1")
def to_date_cast(spark, sf):
    return plain(table(spark, sf, "events").groupBy(X.as_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("row_count")))


@query("pseudonymise", f"SELECT sha256(CAST(c_custkey AS VARCHAR) || '{PEPPER}') AS user_pseudo_id, c_mktsegment FROM customer")
def pseudonymise(spark, sf):
    return table(spark, sf, "customer").select(pseudonym("c_custkey", PEPPER).alias("user_pseudo_id"), "c_mktsegment")


@query("minor_units", f"SELECT id AS payment_id, amount_cents / 100.0 AS amount FROM {frames.PAYMENTS}")
def minor_units(spark, sf):
    return plain(frames.payments(spark, sf).select(F.col("id").alias("payment_id"), X.minor_units("amount_cents").alias("amount")))


@query("derived_key", "SELECT o_orderkey, (o_orderkey % 6) + 101 AS product_id FROM orders")
def derived_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.bucket_key("o_orderkey", 6, 101).alias("product_id"))


@query("line_total", f"SELECT order_id, product_id, CAST(quantity * unit_price AS DOUBLE) AS item_total FROM {frames.ORDER_ITEMS}")
def line_total(spark, sf):
    items = frames.order_items(spark, sf)
    return plain(items.select("order_id", "product_id", X.product("quantity", "unit_price").alias("item_total")))


def nested(spark, sf):
    """Customers with a struct, an array and a map."""
    balance = F.col("c_acctbal")
    tags = F.array_compact(
        F.array(
            F.when(balance >= 5000, F.lit("premium")),
            F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("engineer")),
            F.when(F.col("c_custkey") % 3 == 0, F.lit("vip")),
        )
    )
    prefs = F.when(
        F.col("c_custkey") % 2 == 0,
        F.create_map(F.lit("theme"), F.lit("dark"), F.lit("segment"), F.col("c_mktsegment")),
    ).otherwise(F.create_map(F.lit("theme"), F.lit("light")))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        X.pack("address", ["c_nationkey", "c_mktsegment"]),
        tags.alias("tags"),
        prefs.alias("prefs"),
    )


@query("struct_access", "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events")
def struct_access(spark, sf):
    parsed = table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint").alias("attributes"))
    return rows.flatten(parsed, {"event_id": "event_id", "k": "attributes.k"})


@query("struct_build", "SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment FROM customer")
def struct_build(spark, sf):
    return rows.flatten(nested(spark, sf), {"id": "id", "nation": "address.c_nationkey", "segment": "address.c_mktsegment"})


@query("array_membership", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal >= 5000")
def array_membership(spark, sf):
    return rows.where_contains(nested(spark, sf), "tags", "premium").select("id", "name")


@query(
    "explode_rows",
    """SELECT c_custkey AS id, 'premium' AS tag FROM customer WHERE c_acctbal >= 5000 UNION ALL
    SELECT c_custkey, 'engineer' FROM customer WHERE c_mktsegment = 'MACHINERY' UNION ALL
    SELECT c_custkey, 'vip' FROM customer WHERE c_custkey % 3 = 0""",
)
def explode_rows(spark, sf):
    return rows.explode_rows(nested(spark, sf).select("id", "tags"), "tags", "tag")


@query(
    "map_lookup",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'dark' ELSE 'light' END AS theme,
    CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer""",
)
def map_lookup(spark, sf):
    return nested(spark, sf).select("id", X.map_get("prefs", "theme").alias("theme"), X.map_get("prefs", "segment").alias("segment"))


@query(
    "chain_steps",
    f"""SELECT order_id, user_id, CAST(amount AS DOUBLE) AS amount, CAST(tax AS DOUBLE) AS tax_amount,
    CAST(amount + tax AS DOUBLE) AS total_with_tax, CASE WHEN amount + tax >= 150000 THEN 'VIP' ELSE 'REGULAR' END AS priority
    FROM (SELECT *, round(amount * CAST(0.07 AS DECIMAL(7,6)), 2) AS tax FROM {frames.LAB_ORDERS} WHERE status <> 'P')""",
)
def chain_steps(spark, sf):
    return plain(
        rows.pipe(
            frames.lab_orders(spark, sf),
            lambda df: rows.where_equal(df, "status", frames.CANCELLED, negate=True),
            lambda df: df.withColumn("tax_amount", X.scaled("amount", TAX)),
            lambda df: df.withColumn("total_with_tax", F.col("amount") + F.col("tax_amount")),
            lambda df: df.withColumn("priority", X.tier("total_with_tax", [(150000, "VIP")], "REGULAR")),
            lambda df: df.select("order_id", "user_id", "amount", "tax_amount", "total_with_tax", "priority"),
            lambda df: rows.sort_by(df, [("total_with_tax", "desc"), "order_id"]),
        )
    )


# Sorting and limits


@query("sort_multi", "SELECT p_brand, p_retailprice, p_partkey FROM part ORDER BY p_brand, p_retailprice DESC, p_partkey")
def sort_multi(spark, sf):
    parts = table(spark, sf, "part").select("p_brand", "p_retailprice", "p_partkey")
    return rows.sort_by(parts, ["p_brand", ("p_retailprice", "desc"), "p_partkey"])


@query("preview_limit", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def preview_limit(spark, sf):
    return rows.preview(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), order=["o_orderkey"])


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark, sf):
    return rows.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, ["o_orderkey"])


# Sets


@query("distinct_rows", f"SELECT DISTINCT endpoint, user_id FROM {frames.WEB_LOGS} WHERE status_code = 200")
def distinct_rows(spark, sf):
    logs = rows.where_equal(frames.web_logs(spark, sf), "status_code", 200)
    return rows.distinct_rows(logs, ["endpoint", "user_id"])


@query(
    "append_rows",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def append_rows(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return rows.append_rows(customers, suppliers)


@query(
    "diff_expected",
    """WITH e AS (SELECT o_custkey AS user_id, o_orderpriority AS kind, count(*) AS n FROM orders GROUP BY 1, 2),
    a AS (SELECT o_custkey AS user_id, CASE WHEN o_orderkey % 9 = 0 THEN '5-LOW' ELSE o_orderpriority END AS kind,
    count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT user_id, kind, CASE WHEN net > 0 THEN 'missing' ELSE 'unexpected' END AS side, abs(net) AS copies FROM (
    SELECT coalesce(e.user_id, a.user_id) AS user_id, coalesce(e.kind, a.kind) AS kind,
    coalesce(e.n, 0) - coalesce(a.n, 0) AS net FROM e FULL JOIN a ON e.user_id = a.user_id AND e.kind = a.kind)
    WHERE net <> 0""",
)
def diff_expected(spark, sf):
    orders = table(spark, sf, "orders")
    kind = F.col("o_orderpriority")
    expected = orders.select(F.col("o_custkey").alias("user_id"), kind.alias("kind"))
    changed = F.when(F.col("o_orderkey") % 9 == 0, F.lit("5-LOW")).otherwise(kind)
    return rows.diff(expected, orders.select(F.col("o_custkey").alias("user_id"), changed.alias("kind")))


@query(
    "diff_by_parts",
    """SELECT id, price, 'missing' AS side, count(*) AS copies FROM (SELECT o_orderkey AS id, round(o_totalprice, 2) AS price
    FROM orders WHERE o_orderkey % 499 = 0) GROUP BY 1, 2 UNION ALL
    SELECT o_orderkey, round(o_totalprice, 2) + 1, 'unexpected', count(*) FROM orders WHERE o_orderkey % 499 = 0
    AND o_orderkey % 2 = 0 GROUP BY 1, 2""",
)
def diff_by_parts(spark, sf):
    """Of some orders the price is another, some are gone; ranges of 1,000 ids without one are left where they are."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.round("o_totalprice", 2).alias("price"))
    hit = F.col("id") % 499 == 0
    actual = orders.where(~hit | (F.col("id") % 2 == 0)).withColumn("price", F.when(hit, F.col("price") + 1).otherwise(F.col("price")))
    return rows.diff_by_parts(orders, actual, ["id"], part=F.floor(F.col("id") / 1000))
