"""Sources, sinks and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.expressions import money
from quern.operators.rows import flatten
from quern.operators.skew import parts_for
from quern.queries.registry import plain, query
from quern.session import new_folder, new_name
from quern.sources import readers, rows, writers
from quern.sources.tables import SCHEMAS, driver_sources, table

# Fixed seed rows: a label and a weight per event type, and a label per region.
EVENT_SEED = [
    ("click", "engagement", 1),
    ("error", "problem", 0),
    ("purchase", "revenue", 5),
    ("signup", "growth", 3),
    ("view", "engagement", 1),
]
ROWS_PER_FILE = 10_000_000
REGION_ROWS = [(0, "south"), (1, "west"), (2, "east"), (3, "north")]


@query(
    "scan_csv_typed",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def scan_csv_typed(spark, sf):
    path = new_folder(spark, "csv")
    table(spark, sf, "orders").write.option("header", "true").csv(path)
    return readers.scan_csv(spark, path, SCHEMAS["orders"])


@query(
    "scan_json_nested",
    """SELECT event_id, event_type, user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, value AS price
    FROM events""",
)
def scan_json_nested(spark, sf):
    path = new_folder(spark, "json")
    attributes = F.from_json("props", "k bigint")
    (
        table(spark, sf, "events")
        .select(
            "event_id",
            "event_type",
            "user_id",
            F.struct(attributes["k"].alias("k"), F.col("value").alias("price")).alias("attributes"),
        )
        .write.json(path)
    )
    schema = "event_id bigint, event_type string, user_id bigint, attributes struct<k:bigint,price:double>"
    nested = readers.scan_json(spark, path, schema)
    return flatten(
        nested,
        {"event_id": "event_id", "event_type": "event_type", "user_id": "user_id", "k": "attributes.k",
         "price": "attributes.price"},
    )


@query("scan_parquet", "SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_size > 25")
def scan_parquet(spark, sf):
    part = readers.scan_parquet(spark, f"{sf}/part.parquet", SCHEMAS["part"])
    return part.where("p_size > 25").select("p_partkey", "p_brand", "p_retailprice")


@query(
    "seed_lookup",
    """SELECT s.label, count(*) AS events, CAST(sum(s.weight) AS BIGINT) AS weight
    FROM events e JOIN (VALUES ('click', 'engagement', 1), ('error', 'problem', 0), ('purchase', 'revenue', 5),
    ('signup', 'growth', 3), ('view', 'engagement', 1)) s(event_type, label, weight)
    ON e.event_type = s.event_type GROUP BY s.label""",
)
def seed_lookup(spark, sf):
    name = new_name("event_labels")
    rows.seed(spark, EVENT_SEED, "event_type string, label string, weight int", name)
    labels = spark.table(name)
    # Counted per type first: the join then sees one row per type.
    per_type = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_type.join(F.broadcast(labels), "event_type")  # five checked-in rows
        .groupBy("label")
        .agg(F.sum("n").alias("events"), F.sum(F.col("n") * F.col("weight")).alias("weight"))
    )


@query("named_source", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 5000")
def named_source(spark, sf):
    customers = driver_sources(sf).source(spark, "raw", "customer")
    return customers.where("c_acctbal > 5000").select("c_custkey", "c_name", "c_mktsegment")


@query("write_partitioned", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def write_partitioned(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return writers.write_partitioned(orders, new_folder(spark, "partitioned"), ["o_orderstatus"])


@query(
    "write_partitioned_text",
    "SELECT o_orderkey, o_totalprice, lpad(CAST(o_custkey % 12 AS VARCHAR), 3, '0') AS branch FROM orders",
)
def write_partitioned_text(spark, sf):
    """Text keys with leading zeros come back as they were."""
    branch = F.lpad((F.col("o_custkey") % 12).cast("string"), 3, "0").alias("branch")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", branch)
    return writers.write_partitioned(orders, new_folder(spark, "branches"), ["branch"])


@query(
    "partition_pruned_read",
    "SELECT event_id, user_id, value, event_type FROM events WHERE event_type = 'purchase' AND value > 10",
)
def partition_pruned_read(spark, sf):
    path = new_folder(spark, "events_by_type")
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    writers.write_partitioned(events, path, ["event_type"])
    return readers.read_where(spark, path, "event_type = 'purchase' AND value > 10", events.schema)


@query(
    "bucketed_join",
    """SELECT o_orderpriority, count(*) AS items,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
)
def bucketed_join(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", money("l_extendedprice").alias("price")
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_orderpriority")
    fact, dim = writers.write_bucketed_pair(items, orders, "order_id", ["order_id", "l_linenumber", "price"])
    joined = fact.hint("merge").join(dim, ["order_id", "__salt"])
    return plain(
        joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("items"), F.sum("price").alias("revenue"))
    )


@query("compact_parquet", "SELECT event_id, event_type, value FROM events")
def compact_parquet(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    files = parts_for(events, ROWS_PER_FILE, at_least=2)
    return writers.write_compact(events, new_folder(spark, "compact"), files, "zstd", F.col("event_id"))


@query(
    "write_modes",
    "SELECT o_orderstatus, 2 * count(*) AS row_count FROM orders GROUP BY o_orderstatus",
)
def write_modes(spark, sf):
    path = new_folder(spark, "modes")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    writers.write(orders, path, "overwrite")
    writers.write(orders, path, "append")
    writers.write(orders, path, "ignore")
    return spark.read.schema(orders.schema).parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "temp_view_sql",
    """SELECT c_mktsegment, count(*) AS customers, max(c_acctbal) AS richest FROM customer
    WHERE c_acctbal >= 1000 GROUP BY c_mktsegment""",
)
def temp_view_sql(spark, sf):
    return rows.sql(
        spark,
        """SELECT c_mktsegment, count(*) AS customers, max(c_acctbal) AS richest FROM {customers}
        WHERE c_acctbal >= :floor GROUP BY c_mktsegment""",
        {"customers": table(spark, sf, "customer")},
        floor=1000,
    )


@query(
    "inline_rows",
    """SELECT c.c_custkey, n.n_name, r.side FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN (VALUES (0, 'south'), (1, 'west'), (2, 'east'), (3, 'north')) r(regionkey, side)
    ON n.n_regionkey = r.regionkey""",
)
def inline_rows(spark, sf):
    sides = rows.inline_rows(spark, REGION_ROWS, "n_regionkey int, side string")
    nations = F.broadcast(table(spark, sf, "nation").join(F.broadcast(sides), "n_regionkey"))  # 25 rows at any scale
    customers = table(spark, sf, "customer")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "side")


@query(
    "warehouse_export_import",
    """SELECT 'stored_customer' AS name, c_custkey AS key, c_name AS label, c_acctbal AS amount FROM customer UNION ALL
    SELECT 'stored_orders', o_orderkey, o_orderstatus, o_totalprice FROM orders UNION ALL
    SELECT 'stored_part', p_partkey, p_name, p_retailprice FROM part""",
)
def warehouse_export_import(spark, sf):
    """Every row of three tables after a dump and a restore."""
    held = {
        "customer": ("c_custkey", "c_name", "c_acctbal"),
        "orders": ("o_orderkey", "o_orderstatus", "o_totalprice"),
        "part": ("p_partkey", "p_name", "p_retailprice"),
    }
    for name in held:
        table(spark, sf, name).createOrReplaceTempView(f"stored_{name}")
    path = new_folder(spark, "export")
    writers.export_all(spark, path, only=[f"stored_{name}" for name in held])
    restored = writers.import_all(spark, path)
    rows = None
    for name in restored:
        key, label, amount = held[name.removeprefix("stored_")]
        part = spark.table(name).select(
            F.lit(name).alias("name"), F.col(key).alias("key"), F.col(label).alias("label"), F.col(amount).alias("amount")
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows
