"""Operators on small tables with answers worked out by hand."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from quern.functions import expressions as X
from quern.functions.masking import add_tax, mask_name, pseudonym
from quern.operators import aggregates as A
from quern.operators import layout, rows
from quern.operators import windows as W
from quern.plans.metrics import SemanticModel, metric
from quern.plans.project import medallion, project
from tests import data
from tests.conftest import rows_of


def test_paid_revenue_by_customer(spark):
    marts = project({"orders": data.frame(spark, data.RAW_ORDERS)})
    assert rows_of(marts["fct_revenue_by_customer"]) == [(1, D("42.00")), (2, D("18.50")), (3, D("12.75")), (4, D("55.00"))]


def test_completed_spend_by_user(spark):
    completed = rows.where_equal(data.frame(spark, data.LAB_ORDERS), "status", "COMPLETED")
    out = A.summarise(
        completed, ["user_id"],
        [F.count("order_id"), F.sum("amount"), A.mean("amount"), F.min("amount"), F.max("amount")],
    )
    assert rows_of(out) == [
        (1, 2, D("237.50"), 118.75, D("95.00"), D("142.50")),
        (2, 2, D("154.50"), 77.25, D("65.50"), D("89.00")),
        (3, 1, D("45.25"), 45.25, D("45.25"), D("45.25")),
        (5, 1, D("180.00"), 180.0, D("180.00"), D("180.00")),
    ]


def test_country_revenue(spark):
    out = A.country_revenue(data.frame(spark, data.LAB_ORDERS), data.frame(spark, data.USERS))
    assert rows_of(out) == [
        ("AU", 1, D("180.00"), 180.0), ("CA", 2, D("154.50"), 77.25), ("UK", 1, D("45.25"), 45.25),
        ("US", 2, D("237.50"), 118.75),
    ]


def test_tiers_take_the_first_bound_reached(spark):
    orders = data.frame(spark, data.LAB_ORDERS)
    out = orders.select("order_id", X.tier("amount", [(200, "HIGH"), (100, "MEDIUM")], "LOW"))
    assert dict(rows_of(out)) == {
        101: "MEDIUM", 102: "LOW", 103: "HIGH", 104: "LOW", 105: "HIGH", 106: "LOW", 107: "MEDIUM", 108: "LOW",
    }
    raw = data.frame(spark, data.RAW_ORDERS)
    edge = raw.select("id", X.tier("amount", [(50, "high"), (20, "medium")], "low"))
    assert dict(rows_of(edge)) == {101: "medium", 102: "low", 103: "high", 104: "low", 105: "high", 106: "low"}


def test_rounding_is_half_up_on_exact_decimals(spark):
    df = spark.createDataFrame([(D("2.50"),), (D("0.35"),)], "a decimal(18,2)")
    assert [r[0] for r in df.select(X.scaled("a", "0.07")).collect()] == [D("0.18"), D("0.02")]
    cents = spark.createDataFrame([(4205,), (-1,)], "c bigint")
    assert [r[0] for r in cents.select(X.minor_units("c")).collect()] == [D("42.05"), D("-0.01")]


def test_keys_and_maps(spark):
    df = spark.createDataFrame([(-1,), (13,)], "k bigint")
    assert [r[0] for r in df.select(X.bucket_key("k", 6, 101)).collect()] == [106, 102]
    nested = data.frame(spark, data.NESTED_USERS)
    assert rows_of(nested.select("id", X.map_get("prefs", "theme")))[0] == (1, "dark")
    assert all(r[0] is None for r in nested.select(X.map_get("prefs", "none")).collect())


def test_dirty_users(spark):
    dirty = data.frame(spark, data.DIRTY_USERS)
    clean = rows.fill(rows.drop_null_keys(dirty, ["id"]), {"email": "no-reply@company.com"})
    clean = clean.withColumn("country", X.default_to("country", value="GLOBAL"))
    by_id = {r.id: r for r in clean.collect()}
    assert by_id[2].email == by_id[6].email == "no-reply@company.com"
    assert by_id[4].country == "GLOBAL" and by_id[3].name is None


def test_explode_leaves_out_empty_arrays(spark):
    nested = data.frame(spark, data.NESTED_USERS).select("id", "tags")
    assert len(rows_of(rows.explode_rows(nested, "tags", "tag"))) == 6
    assert (4, None) in rows_of(rows.explode_rows(nested, "tags", "tag", outer=True))
    assert rows_of(rows.where_contains(nested, "tags", "premium").select("id")) == [(1,), (3,)]


def test_pivot_gives_zero_not_null(spark):
    paid = data.frame(spark, data.PAYMENTS).withColumn("amount", X.minor_units("amount_cents"))
    methods = ["credit_card", "bank_transfer", "gift_card"]
    out = A.pivot_sum(paid, ["order_id"], "payment_method", "amount", methods)
    assert rows_of(out)[0] == (101, D("42.00"), D("0.00"), D("0.00"))
    assert rows_of(out)[3] == (104, D("0.00"), D("0.00"), D("12.75"))
    by_method = {r.order_id: r.amounts for r in A.pivot_map(paid, ["order_id"], "payment_method", "amount").collect()}
    assert by_method[101] == {"credit_card": D("42.00")} and by_method[104] == {"gift_card": D("12.75")}


def test_pivot_map_has_no_bound_on_values(spark):
    rows = spark.range(3000).selectExpr("1 AS g", "cast(id AS string) AS k", "id AS v").union(
        spark.sql("SELECT 1, cast(NULL AS string), 5L")
    )
    assert len(A.pivot_map(rows, ["g"], "k", "v").first().amounts) == 3000


def test_window_answers(spark):
    sales = data.frame(spark, data.DAILY_SALES)
    total = W.add_running_sum(sales, ["store_id"], ["date"], "sales_amount")
    both = W.add_neighbours(total, ["store_id"], ["date"], "sales_amount")
    got = rows_of(both.where("store_id = 'S01'"), "running_total", "previous")
    assert sorted(got, key=lambda r: r[0]) == [
        (D("4200.00"), None), (D("8700.00"), D("4200.00")), (D("13800.25"), D("4500.00")),
    ]


def test_latency_and_distinct(spark):
    logs = data.frame(spark, data.WEB_LOGS)
    out = {r[0]: (r[1], r[2]) for r in A.latency_summary(logs, ["endpoint"], "response_ms").collect()}
    assert out["/api/v1/products"] == (3, 39.0) and out["/api/v1/checkout"] == (1, 320.0)
    pairs = rows.distinct_rows(rows.where_equal(logs, "status_code", 200), ["endpoint", "ip_address"])
    assert pairs.count() == 6


def test_medallion(spark, folder):
    out = medallion(
        data.frame(spark, data.LAB_ORDERS), data.frame(spark, data.USERS), data.frame(spark, data.PRODUCTS),
        folder(), n_products=6, offset=101,
    )
    assert rows_of(out) == [
        ("AU", "Kitchen", D("180.00"), 1, 1), ("CA", "Electronics", D("154.50"), 2, 1), ("UK", "Kitchen", D("45.25"), 1, 1),
        ("US", "Electronics", D("95.00"), 1, 2), ("US", "Kitchen", D("142.50"), 1, 1),
    ]


def test_masking(spark):
    names = ["Alice Johnson", "Cher", "", None, "A B C", "Two  Spaces", " lead"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(mask_name("name")).collect()]
    assert got[:4] == ["Alice J.", "Cher", "", ""] and got[4] == "A B."


def test_pseudonyms_and_tax(spark):
    import hashlib

    df = spark.createDataFrame([(7, 10.0)], "id bigint, amount double")
    row = df.select(pseudonym("id", "_p"), add_tax("amount")).first()
    assert row[0] == hashlib.sha256(b"7_p").hexdigest()
    assert row[1] == 10.0 * 1.0825


def test_custom_partitions_keep_buckets_apart(spark):
    users = data.frame(spark, data.USERS)
    mapping = {0: ["US", "CA"], 1: ["UK", "DE", "FR"]}
    placed = layout.partition_by_bucket(
        users.withColumn("bucket", layout.region_buckets("country", mapping, 2)), "bucket", 3, 2, ["id"]
    )
    sizes = layout.partition_sizes(placed, "bucket").collect()
    assert {s.partition_id // 2 for s in sizes} == {0, 1, 2}
    assert all(s.partition_id // 2 == s.bucket for s in sizes)
    per_bucket = {b: sum(s.row_count for s in sizes if s.bucket == b) for b in (0, 1, 2)}
    assert per_bucket == {0: 4, 1: 3, 2: 1}


def test_partition_counts(spark):
    df = spark.range(100)
    assert layout.repartitioned(df, 7).rdd.getNumPartitions() == 7
    assert layout.coalesced(layout.repartitioned(df, 7), 3).rdd.getNumPartitions() <= 3
    assert layout.coalesced(layout.repartitioned(df, 7), 3).count() == 100


def test_cached_frame_is_released(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert layout.with_cached(df, [lambda d: d.count(), lambda d: d.agg(F.max("x")).first()[0]]) == [10, 18]
    assert not df.storageLevel.useMemory


def test_skew_report_flags_hot_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id") % 10 + 1).alias("k"))
    out = {r.k: r for r in layout.skew_report(df, "k", 5).collect()}
    assert out[0].is_hot and out[0].rows_per_key == 900 and out[1].median_rows == 10.0
    assert not any(out[k].is_hot for k in range(1, 11))


def test_observed_errors_count_every_row(spark, folder):
    watched, watch = layout.observe_errors(data.frame(spark, data.WEB_LOGS), F.col("status_code") >= 400)
    watched.write.parquet(folder())
    assert watch.get == {"seen": 8, "matched": 2}


def test_even_squares(spark):
    out = layout.even_squares(spark.range(1, 11), "id")
    assert [(int(a), int(b)) for a, b in rows_of(out)] == sorted([(n, n * n) for n in (2, 4, 6, 8, 10)], key=lambda r: tuple((False, str(v)) for v in r))


def test_metrics_refuse_unknown_names(spark):
    model = SemanticModel(
        data.frame(spark, data.LAB_ORDERS), {"revenue": ("sum", "amount")}, ["status"], "created_at"
    )
    out = rows_of(metric(model, ["revenue"], ["status"], "month"))
    assert out[1] == ("COMPLETED", dt.datetime(2024, 1, 1), D("617.25"))
    for bad in (["profit"], ["revenue"]):
        dims = ["city"] if bad == ["revenue"] else []
        try:
            metric(model, bad, dims)
        except LookupError:
            continue
        raise AssertionError("undeclared names must be refused")


def test_lookback_and_until_include_their_bounds(spark):
    orders = data.frame(spark, data.RAW_ORDERS)
    assert rows.where_until(orders, "created_at", dt.date(2024, 2, 1)).count() == 4
    assert rows.where_recent(orders, "created_at", 5, dt.date(2024, 2, 9)).count() == 2


def test_diff_respects_counts(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert rows_of(rows.diff(a, b)) == [(1, "missing", 1), (2, "missing", 1), (3, "unexpected", 1)]
