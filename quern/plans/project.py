"""Whole projects: staging to marts, and raw to refined to ranked KPIs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.expressions import as_date, bucket_key, minor_units
from quern.operators.aggregates import sum_by
from quern.operators.joins import join_small
from quern.operators.rows import rename_select, where_equal
from quern.operators.windows import rank_totals
from quern.plans.builds import build_table
from quern.plans.history import current_rows
from quern.sources.writers import write_partitioned


def stg_orders(orders: DataFrame) -> DataFrame:
    return rename_select(
        orders,
        {"order_id": "id", "customer_id": "customer_id", "amount": "amount", "status": "status", "created_at": "created_at"},
    )


def project(sources: Mapping[str, DataFrame], paid: str = "paid", checkout: str = "checkout") -> dict[str, DataFrame]:
    """Models of a project by name, from the sources it was given: staging, then intermediate, then marts."""
    models = {}
    if "orders" in sources:
        models["stg_orders"] = stg_orders(sources["orders"])
        models["int_paid_orders"] = where_equal(models["stg_orders"], "status", paid)
        models["fct_revenue_by_customer"] = sum_by(models["int_paid_orders"], ["customer_id"], "amount", "revenue")
    if "customers" in sources:
        models["stg_customers"] = sources["customers"].select("id", "name", "email", "country")
        models["dim_customers"] = models["stg_customers"].withColumnRenamed("id", "customer_id")
    if "payments" in sources:
        models["stg_payments"] = sources["payments"].select(
            F.col("id").alias("payment_id"), "order_id", "payment_method", minor_units("amount_cents").alias("amount")
        )
    if "app_events" in sources:
        models["fct_app_events"] = sources["app_events"].select(
            "event_id", "user_id", "event_name", (F.col("event_name") == checkout).alias("is_checkout"), "event_timestamp"
        )
    if "subscription_history" in sources:
        models["dim_current_subscriptions"] = current_rows(sources["subscription_history"]).select(
            F.col("id").alias("subscription_id"), "customer_id", "plan", "status"
        )
    return models


def medallion(
    orders: DataFrame,
    users: DataFrame,
    products: DataFrame,
    root: str,
    n_products: int | None = None,
    offset: int = 0,
    completed: str = "COMPLETED",
) -> DataFrame:
    """Raw tables stored as they came, completed orders joined and stored by country, then categories ranked by
    revenue inside each country. Orders that do not name a product get one of `n_products` by their number."""
    bronze = {
        name: build_table(frame, f"{root}/bronze/{name}")
        for name, frame in (("orders", orders), ("users", users), ("products", products))
    }
    done = where_equal(bronze["orders"], "status", completed)
    keyed = done if n_products is None else done.withColumn("product_id", bucket_key("order_id", n_products, offset))
    people = bronze["users"].select(F.col("id").alias("user_id"), F.col("name").alias("user_name"), "country")
    goods = bronze["products"].select("product_id", F.col("name").alias("product_name"), "category")
    joined = join_small(keyed.join(people, "user_id"), goods, ["product_id"], "left")
    silver = write_partitioned(
        joined.select(
            "order_id", "user_id", "user_name", "country", "product_name", "category", "amount",
            as_date("created_at").alias("order_date"),
        ),
        f"{root}/silver/enriched_orders",
        ["country"],
    )
    return build_table(rank_totals(silver, "category", "country", "amount"), f"{root}/gold/country_category_kpis")
