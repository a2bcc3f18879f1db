"""Table builds: views, tables, incremental loads, gates, audits, versions of models, whole projects."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quern.functions.expressions import clean_text
from quern.operators.quality import accepted_values, is_between, is_positive, unique
from quern.plans import builds, versions
from quern.plans.project import medallion as build_medallion
from quern.plans.project import project
from quern.queries import frames
from quern.queries.registry import plain, query
from quern.session import new_folder, new_name
from quern.sources.tables import table
from quern.sources.writers import write_partitioned

NOON = dt.datetime(2024, 4, 1, 12, 0)


def orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query("build_view", "SELECT o_orderpriority, count(*) AS row_count FROM orders GROUP BY 1")
def build_view(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("row_count"))
    return builds.build_view(counted, new_name("orders_by_priority"))


@query("build_table", "SELECT l_shipdate, count(*) AS items FROM lineitem GROUP BY 1")
def build_table(spark, sf):
    per_day = table(spark, sf, "lineitem").groupBy("l_shipdate").agg(F.count(F.lit(1)).alias("items"))
    return builds.build_table(per_day, new_folder(spark, "items_per_day"))


@query(
    "build_inline",
    f"""SELECT order_id, CAST(sum(quantity * unit_price) AS DOUBLE) AS order_total FROM {frames.ORDER_ITEMS} GROUP BY order_id""",
)
def build_inline(spark, sf):
    items = builds.build_inline(
        lambda raw: raw.withColumn("item_total", F.col("quantity") * F.col("unit_price")), frames.order_items(spark, sf)
    )
    return plain(items.groupBy("order_id").agg(F.sum("item_total").alias("order_total")))


# Incremental loads


@query("incr_first_run", f"SELECT * FROM {frames.APP_EVENTS}")
def incr_first_run(spark, sf):
    return builds.build_incremental(new_folder(spark, "first_run"), frames.app_events(spark, sf), "event_timestamp")


HOURLY = """(SELECT event_id, user_id, date_trunc('hour', ts)::TIMESTAMP AS event_hour, ts FROM events)"""


@query(
    "incr_watermark",
    f"""SELECT event_id, user_id, event_hour FROM {HOURLY} WHERE ts < TIMESTAMP '2024-01-20 12:30:00' OR event_hour >
    (SELECT max(event_hour) FROM {HOURLY} WHERE ts < TIMESTAMP '2024-01-20 12:30:00')""",
)
def incr_watermark(spark, sf):
    events = table(spark, sf, "events").withColumn("event_hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    cols = ["event_id", "user_id", "event_hour"]
    root = new_folder(spark, "watermark")
    builds.build_incremental(root, events.where("ts < timestamp_ntz'2024-01-20 12:30:00'").select(*cols), "event_hour")
    return builds.build_incremental(root, events.select(*cols), "event_hour")


@query(
    "incr_append",
    """SELECT o_orderkey, o_totalprice FROM orders UNION ALL
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 4 = 0""",
)
def incr_append(spark, sf):
    all_orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    root = new_folder(spark, "append")
    builds.build_incremental(root, all_orders)
    return builds.build_incremental(root, all_orders.where("o_orderkey % 4 = 0"), strategy="append")


def upsert_batch(df):
    """Every third order twice, first at price 1 and later at price 2, and a new order for every tenth."""
    third = df.where("o_orderkey % 3 = 0")
    new = df.where("o_orderkey % 10 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    priced = [
        frame.withColumn("o_totalprice", F.lit(float(step))).withColumn("seq", F.lit(step))
        for step, frame in ((1, third), (2, third), (3, new))
    ]
    return priced[0].unionByName(priced[1]).unionByName(priced[2])


@query(
    "incr_merge",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 2.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL SELECT -o_orderkey - 1, o_custkey, 3.0::DOUBLE FROM orders WHERE o_orderkey % 10 = 0""",
)
def incr_merge(spark, sf):
    start = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").withColumn("seq", F.lit(0))
    root = new_folder(spark, "merge")
    builds.build_incremental(root, start, None, ["o_orderkey"], "merge")
    merged = builds.build_incremental(root, upsert_batch(start), None, ["o_orderkey"], "merge", ["seq"])
    return merged.drop("seq")


@query(
    "incr_delete_insert",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL
    SELECT o_orderkey, v::DOUBLE FROM orders, (VALUES (1), (2)) t(v) WHERE o_orderkey % 3 = 0
    UNION ALL SELECT -o_orderkey - 1, 3.0::DOUBLE FROM orders WHERE o_orderkey % 10 = 0""",
)
def incr_delete_insert(spark, sf):
    start = table(spark, sf, "orders").select("o_orderkey", "o_totalprice").withColumn("seq", F.lit(0))
    root = new_folder(spark, "delete_insert")
    builds.build_incremental(root, start, None, ["o_orderkey"], "delete+insert")
    return builds.build_incremental(root, upsert_batch(start), None, ["o_orderkey"], "delete+insert").drop("seq")


@query(
    "incr_predicates",
    """WITH t AS (SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders)
    SELECT o_orderkey, CASE WHEN o_year >= 2000 AND o_orderkey % 8 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
    o_year FROM t UNION ALL SELECT o_orderkey, 0.0::DOUBLE, o_year FROM t WHERE o_year < 2000 AND o_orderkey % 8 = 0""",
)
def incr_predicates(spark, sf):
    dated = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"))
    path = new_folder(spark, "by_year")
    write_partitioned(dated, path, ["o_year"])
    batch = dated.where("o_orderkey % 8 = 0").withColumn("o_totalprice", F.lit(0.0))
    return builds.merge_window(path, dated.schema, batch, ["o_orderkey"], ["o_year"], "o_year >= 2000")


@query(
    "incr_predicates_parts",
    """WITH t AS (SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders)
    SELECT o_orderkey, CASE WHEN o_year >= 2000 AND o_orderkey % 8 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
    o_year FROM t UNION ALL SELECT o_orderkey, 0.0::DOUBLE, o_year FROM t WHERE o_year < 2000 AND o_orderkey % 8 = 0""",
)
def incr_predicates_parts(spark, sf):
    dated = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"))
    # Labels with characters that file systems and folder names know otherwise, and null for the years before 1996.
    year = F.col("o_year")
    labelled = dated.withColumn("label", F.when(year >= 1996, F.concat(F.lit("y/"), year, F.lit("=10:30 %"))))
    path = new_folder(spark, "year_parts")
    write_partitioned(labelled, path, ["label"])
    batch = labelled.where("o_orderkey % 8 = 0").withColumn("o_totalprice", F.lit(0.0))
    window = F.col("label").isin([f"y/{year}=10:30 %" for year in range(2000, 2010)])
    return builds.merge_window(path, labelled.schema, batch, ["o_orderkey"], ["label"], window).drop("label")


@query(
    "incr_watermark_merge",
    """SELECT event_id, user_id, CASE WHEN event_id % 5 = 0 THEN 'again' ELSE event_type END AS event_type, ts FROM events
    WHERE event_id % 5 <> 0 OR ts > (SELECT max(ts) FROM events WHERE event_id % 2 = 0)
    UNION ALL SELECT event_id, user_id, event_type, ts FROM events
    WHERE event_id % 5 = 0 AND ts <= (SELECT max(ts) FROM events WHERE event_id % 2 = 0)""",
)
def incr_watermark_merge(spark, sf):
    """A fact with a unique key and a watermark in one model: late rows that lie before the watermark are not loaded."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    first = table(spark, sf, "events").where("event_id % 2 = 0").agg(F.max("ts").alias("newest"))
    start = events.join(F.broadcast(first), F.col("ts") <= F.col("newest")).drop("newest")  # one row
    root = new_folder(spark, "fct_events")
    builds.build_incremental(root, start, "ts", ["event_id"], "merge")
    again = F.when(F.col("event_id") % 5 == 0, F.lit("again")).otherwise(F.col("event_type"))
    return builds.build_incremental(root, events.withColumn("event_type", again), "ts", ["event_id"], "merge")


@query(
    "governed_product",
    f"""SELECT o.order_id, sha256('pepper' || CAST(u.id AS VARCHAR)) AS user_token, u.country,
    CAST(o.amount AS DOUBLE) AS amount FROM {frames.LAB_ORDERS} o JOIN {frames.USERS} u ON o.user_id = u.id
    WHERE o.status = 'F' AND o.amount > 0""",
)
def governed_product(spark, sf):
    """Clean orders joined to pseudonymised users; the raw id does not leave the build."""
    people = frames.users(spark, sf).select(
        F.col("id").alias("user_id"), F.sha2(F.concat(F.lit("pepper"), F.col("id").cast("string")), 256).alias("user_token"), "country"
    )
    orders = frames.lab_orders(spark, sf).where("status = 'F' AND amount > 0")
    return plain(orders.join(people, "user_id").select("order_id", "user_token", "country", "amount"))


@query("incr_full_refresh", "SELECT event_id, user_id, event_type = 'purchase' AS is_purchase FROM events")
def incr_full_refresh(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    root = new_folder(spark, "refresh")
    builds.build_incremental(root, events.where("event_id % 2 = 0").select("event_id", "user_id"))
    flagged = events.select("event_id", "user_id", (F.col("event_type") == "purchase").alias("is_purchase"))
    return builds.build_incremental(root, flagged, full_refresh=True)


# Gates and audits


@query("publish_blue_green", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def publish_blue_green(spark, sf):
    root = new_folder(spark, "published")
    checks = {
        "key_unique": (lambda df: unique(df, ["o_orderkey"]),),
        "status_known": (lambda df: accepted_values(df, "o_orderstatus", ["F", "O"]),),
    }
    good = orders(spark, sf).where("o_orderstatus <> 'P'")
    builds.publish(good, checks, root, NOON)
    builds.publish(orders(spark, sf), checks, root, NOON)  # holds status P, so readers keep the former version
    return versions.as_of_version(spark, root).select("o_orderkey", "o_totalprice")


@query(
    "gated_publish",
    """SELECT 'model' AS model, 'positive' AS "check", count(*) AS failures,
    CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END AS status FROM lineitem WHERE l_quantity <= 0 UNION ALL
    SELECT 'model', 'small', count(*), CASE WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END FROM lineitem WHERE l_quantity > 45
    UNION ALL SELECT 'written', 'rows', count(*), 'pass' FROM lineitem""",
)
def gated_publish(spark, sf):
    path = new_folder(spark, "gated")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    checks = {
        "positive": (lambda df: is_positive(df, "l_quantity"), "error"),
        "small": (lambda df: is_between(df, "l_quantity", max_val=45), "warn"),
    }
    verdicts = builds.gated_publish(items, checks, lambda df: df.write.parquet(path))
    written = spark.read.schema(items.schema).parquet(path).agg(F.count(F.lit(1)).alias("failures"))
    return verdicts.unionByName(
        written.select(F.lit("written").alias("model"), F.lit("rows").alias("check"), "failures", F.lit("pass").alias("status"))
    )


@query(
    "build_audit_log",
    """SELECT 'run-1' AS run_id, 'orders' AS name, count(*) AS row_count, 'success' AS status FROM orders UNION ALL
    SELECT 'run-1', 'customer', count(*), 'success' FROM customer""",
)
def build_audit_log(spark, sf):
    audit = new_folder(spark, "audit")
    for name in ("orders", "customer"):
        target = new_folder(spark, name)
        builds.audited(
            name, lambda n=name, t=target: builds.build_table(table(spark, sf, n), t), audit, "run-1", lambda: NOON
        )
    return spark.read.parquet(audit).select("run_id", "name", "row_count", "status")


@query(
    "schema_routing",
    "SELECT 'analytics_finance' AS schema_name, c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment",
)
def schema_routing(spark, sf):
    schema = builds.schema_name("finance", "analytics", "dev")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{new_folder(spark, schema)}'")
    counted = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    path = new_folder(spark, "segments")
    counted.write.mode("overwrite").option("path", path).saveAsTable(f"{schema}.segments")
    return spark.table(f"{schema}.segments").withColumn("schema_name", F.lit(schema))


@query(
    "model_versions",
    f"""SELECT 'v1' AS version, id, name, NULL::VARCHAR AS email_cleaned, country FROM {frames.USERS} UNION ALL
    SELECT 'latest', id, name, lower(email), country FROM {frames.USERS}""",
)
def model_versions(spark, sf):
    people = frames.users(spark, sf)
    v1 = people.select("id", "name", "country")
    v2 = people.select("id", "name", clean_text("email").alias("email_cleaned"), "country")
    name = new_name("dim_customers")
    latest = builds.register_versions(spark, name, {1: v1, 2: v2}, 2)
    pinned = spark.table(f"{name}_v1").withColumn("version", F.lit("v1"))
    return latest.withColumn("version", F.lit("latest")).unionByName(pinned, allowMissingColumns=True)


# Whole projects


@query(
    "medallion",
    f"""SELECT country, category, CAST(total_revenue AS DOUBLE) AS total_revenue, order_count,
    row_number() OVER (PARTITION BY country ORDER BY total_revenue DESC, category) AS category_rank FROM (
    SELECT u.country, p.category, sum(o.amount) AS total_revenue, count(*) AS order_count FROM {frames.ORDER_LINES} o
    JOIN {frames.USERS} u ON o.user_id = u.id LEFT JOIN {frames.PRODUCTS} p ON o.product_id = p.product_id
    WHERE o.status = 'F' GROUP BY 1, 2)""",
)
def medallion(spark, sf):
    root = new_folder(spark, "medallion")
    ranked = build_medallion(
        frames.order_lines(spark, sf), frames.users(spark, sf), frames.products(spark, sf), root, completed=frames.DONE
    )
    return plain(ranked)


@query(
    "project_marts",
    f"SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS revenue FROM {frames.RAW_ORDERS} WHERE status = 'F' GROUP BY customer_id",
)
def project_marts(spark, sf):
    return plain(project({"orders": frames.raw_orders(spark, sf)}, paid=frames.DONE)["fct_revenue_by_customer"])


@query(
    "project_enterprise",
    f"""SELECT 'stg_payments' AS model, count(*) AS row_count, CAST(sum(amount_cents / 100.0) AS DECIMAL(28,2))::DOUBLE AS total
    FROM {frames.PAYMENTS} UNION ALL
    SELECT 'fct_app_events', count(*), CAST(count(*) FILTER (event_name = 'purchase') AS DOUBLE) FROM {frames.APP_EVENTS}
    UNION ALL SELECT 'dim_customers', count(*), CAST(count(email) AS DOUBLE) FROM {frames.USERS}""",
)
def project_enterprise(spark, sf):
    models = project(
        {"customers": frames.users(spark, sf), "payments": frames.payments(spark, sf), "app_events": frames.app_events(spark, sf)},
        checkout="purchase",
    )
    measures = {
        "stg_payments": F.sum("amount").cast("double"),
        "fct_app_events": F.count(F.when(F.col("is_checkout"), 1)).cast("double"),
        "dim_customers": F.count("email").cast("double"),
    }
    out = None
    for name, measure in measures.items():
        row = models[name].agg(F.count(F.lit(1)).alias("row_count"), measure.alias("total"))
        row = row.select(F.lit(name).alias("model"), "row_count", "total")
        out = row if out is None else out.unionByName(row)
    return out
