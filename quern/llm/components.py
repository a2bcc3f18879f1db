"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import cut_lineage


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie each node's neighbours to the smallest of them and itself.

    With `larger`, a node hands over its larger neighbours; otherwise itself and its smaller ones. Edges (u, v) have u > v
    on return.
    """
    around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = around.join(least, "u")
    if larger:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v) that is not itself the smallest of its component.

    Large stars and small stars alternate until the edges are stars around the smallest node of each component; their
    number of rounds grows with the logarithm of the longest chain. No step holds the neighbours of a node in one row,
    so a node may have any number of them. Nulls and loops are left out; no links give no rows.
    """
    pairs = links.where("u is not null and v is not null and u <> v")
    edges = cut_lineage(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not state.n or (state.n, state.s) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (state.n, state.s)
        edges = cut_lineage(_star(_star(edges, True), False))
