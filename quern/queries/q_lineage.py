"""Walks over edges: each order leads to the same customer's next one."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import lineage as G
from quern.queries import frames
from quern.queries.registry import query
from quern.sources.tables import table

WALK = """WITH RECURSIVE reach(node, distance) AS (SELECT o_orderkey, 0::BIGINT FROM orders WHERE {start} UNION
    SELECT e.{to}, r.distance + 1 FROM {edges} e JOIN reach r ON e.{frm} = r.node)
    SELECT node, min(distance) AS distance FROM reach GROUP BY node"""


def start_nodes(spark, sf, predicate):
    return table(spark, sf, "orders").where(predicate).select(F.col("o_orderkey").alias("node"))


@query(
    "lineage_downstream",
    WALK.format(start="o_orderdate < TIMESTAMP '1995-03-01 00:00:00'", to="target", frm="source", edges=frames.ORDER_EDGES),
)
def lineage_downstream(spark, sf):
    start = start_nodes(spark, sf, "o_orderdate < timestamp_ntz'1995-03-01 00:00:00'")
    return G.downstream(frames.order_edges(spark, sf), start)


@query(
    "lineage_upstream",
    WALK.format(start="o_orderdate > TIMESTAMP '2001-06-01 00:00:00'", to="source", frm="target", edges=frames.ORDER_EDGES),
)
def lineage_upstream(spark, sf):
    start = start_nodes(spark, sf, "o_orderdate > timestamp_ntz'2001-06-01 00:00:00'")
    return G.upstream(frames.order_edges(spark, sf), start)


@query("lineage_cycles", "SELECT o_orderkey AS node FROM orders WHERE o_custkey % 5 = 0")
def lineage_cycles(spark, sf):
    return G.cycle_members(frames.order_edges(spark, sf, cycles=True))


PREFIX = "CASE o_orderstatus WHEN 'F' THEN 'stg_' WHEN 'O' THEN 'int_' ELSE 'fct_' END"


@query(
    "lineage_layers",
    f"""SELECT {PREFIX} || o_orderkey AS node, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    - 1 AS level, CASE o_orderstatus WHEN 'F' THEN 'staging' WHEN 'O' THEN 'intermediate' ELSE 'mart' END AS layer
    FROM orders""",
)
def lineage_layers(spark, sf):
    status = F.col("o_orderstatus")
    prefix = F.when(status == "F", F.lit("stg_")).when(status == "O", F.lit("int_")).otherwise(F.lit("fct_"))
    named = table(spark, sf, "orders").select("o_orderkey", F.concat(prefix, "o_orderkey").alias("node"))
    edges = frames.order_edges(spark, sf)
    by_name = (
        edges.join(named.withColumnRenamed("o_orderkey", "source"), "source")
        .select(F.col("node").alias("source"), "target")
        .join(named.withColumnRenamed("o_orderkey", "target"), "target")
        .select("source", F.col("node").alias("target"))
    )
    return G.layers(named.select("node"), by_name)


@query(
    "lineage_select",
    """SELECT 'order_' || o_orderkey AS node FROM orders WHERE
    ((o_orderstatus = 'F' AND year(o_orderdate) = 1996) OR o_orderpriority = '1-URGENT')
    AND NOT (year(o_orderdate) = 2000 AND o_orderstatus = 'P')""",
)
def lineage_select(spark, sf):
    nodes = table(spark, sf, "orders").select(
        F.concat(F.lit("order_"), "o_orderkey").alias("node"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.concat(F.lit("orders/"), F.year("o_orderdate"), F.lit("/"), "o_orderkey").alias("path"),
    )
    return G.select_nodes(
        nodes,
        groups=[[G.Term("tag", "F"), G.Term("path", "orders/1996")], [G.Term("tag", "1-URGENT")]],
        exclude=[[G.Term("path", "orders/2000"), G.Term("tag", "P")]],
    )


@query(
    "lineage_select_related",
    f"""SELECT node FROM ({WALK.format(
        start="o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1996", to="target", frm="source", edges=frames.ORDER_EDGES
    )}) JOIN orders ON node = o_orderkey WHERE year(o_orderdate) = 1997
    UNION SELECT node FROM ({WALK.format(
        start="o_orderpriority = '5-LOW' AND o_orderdate > TIMESTAMP '2001-06-01 00:00:00'", to="source", frm="target",
        edges=frames.ORDER_EDGES
    )})""",
)
def lineage_select_related(spark, sf):
    """Terms with parents or children: what follows the urgent orders of 1996, of 1997 only, and what led to the last low
    ones."""
    year = F.year("o_orderdate")
    late = F.when(F.col("o_orderdate") > F.lit("2001-06-01").cast("timestamp_ntz"), F.lit("late")).otherwise(F.lit(""))
    nodes = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("node"),
        F.array(F.concat("o_orderpriority", F.lit(" "), year), F.concat("o_orderpriority", late)).alias("tags"),
        F.concat(F.lit("orders/"), year, F.lit("/"), "o_orderkey").alias("path"),
    )
    return G.select_nodes(
        nodes,
        groups=[
            [G.Term("tag", "1-URGENT 1996", downstream=True), G.Term("path", "orders/1997")],
            [G.Term("tag", "5-LOWlate", upstream=True)],
        ],
        edges=frames.order_edges(spark, sf),
    )


@query(
    "changed_downstream",
    WALK.format(start="o_orderkey % 97 = 0 OR o_orderkey % 101 = 0", to="target", frm="source", edges=frames.ORDER_EDGES),
)
def changed_downstream(spark, sf):
    orders = table(spark, sf, "orders")
    node = F.col("o_orderkey").alias("node")
    price = F.col("o_totalprice").cast("string")
    saved = orders.where("o_orderkey % 101 <> 0").select(node, F.md5(price).alias("hash"))
    edited = F.when(F.col("o_orderkey") % 97 == 0, F.concat(price, F.lit("!"))).otherwise(price)
    return G.changed_downstream(saved, orders.select(node, F.md5(edited).alias("hash")), frames.order_edges(spark, sf))
