"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of cells. Every shard owns virtual nodes at hashed cells, and a cell belongs to the next
virtual node clockwise; a row's cell is a hash of its key, so rows of one key go together. No shard takes more rows than
its capacity: what overflows a full shard goes on clockwise to the next that has room. With no spare room, row counts are
at most one apart.

Where the rows of an arc go follows from row counts per cell alone. Those counts are all the driver sees: one row per cell,
and one more for every BLOCK_ROWS rows of a cell, since a cell that holds more (a large group of copies) is cut by a
hash of the row into blocks, each numbered by a task of its own.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.columns import without
from quern.session import cut_lineage

CELLS = 1 << 16
REPLICAS = 128
BLOCK_ROWS = 250_000


def virtual_nodes(shards: int, replicas: int = REPLICAS) -> list[tuple[int, int]]:
    """(cell, shard) around the ring. A shard's nodes do not depend on how many shards there are.

    Of two nodes in one cell the one of the smaller hash stays.
    """
    best: dict[int, tuple[bytes, int]] = {}
    for shard in range(shards):
        for replica in range(replicas):
            digest = hashlib.blake2b(f"{shard}/{replica}".encode(), digest_size=8).digest()
            cell = int.from_bytes(digest, "big") % CELLS
            best[cell] = min(best.get(cell, (digest, shard)), (digest, shard))
    return sorted((cell, shard) for cell, (_, shard) in best.items())


def capacities(rows: int, shards: int, spare: float) -> list[int]:
    """Rows that each shard may take. Without spare room the counts are as equal as they can be."""
    if spare:
        return [-int(-rows * (1 + spare) // shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def place(
    blocks: list[tuple[int, int, int]], shards: int, spare: float = 0.0, replicas: int = REPLICAS
) -> list[tuple[int, int, int, int, int, int]]:
    """Where the rows of each block go: (cell, block, from, to, shard, slot of the first).

    `blocks` are (cell, block, rows). First every arc fills its own shard as far as that has room, clockwise from cell 0;
    then what is left takes one step clockwise after another, all arcs in turn.
    """
    nodes = virtual_nodes(shards, replicas)
    cells = [cell for cell, _ in nodes]
    arcs: dict[int, list] = defaultdict(list)
    at = 0
    for cell, block, rows in sorted(blocks):
        while at < len(cells) and cells[at] < cell:
            at += 1
        arcs[at % len(cells)].append((cell, block, rows))
    free = capacities(sum(rows for _, _, rows in blocks), shards, spare)
    taken = [0] * shards
    left = {arc: sum(rows for _, _, rows in held) for arc, held in arcs.items()}
    parts: dict[int, list] = defaultdict(list)
    step = 0
    while left:
        for arc in sorted(left):
            shard = nodes[(arc + step) % len(nodes)][1]
            rows = min(left[arc], free[shard])
            if rows:
                parts[arc].append((rows, shard, taken[shard]))
                taken[shard] += rows
                free[shard] -= rows
                left[arc] -= rows
        left = {arc: rows for arc, rows in left.items() if rows}
        step += 1
    out = []
    for arc, held in arcs.items():
        todo = iter(parts[arc])
        room, shard, slot = 0, 0, 0
        for cell, block, rows in held:
            done = 0
            while done < rows:
                if not room:
                    room, shard, slot = next(todo)
                took = min(room, rows - done)
                out.append((cell, block, done, done + took, shard, slot))
                done, room, slot = done + took, room - took, slot + took
    return out


def shard_rows(
    docs: DataFrame, key: Column, shards: int, id_col: str = "doc_id", spare: float = 0.0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add shard (from 0) and slot (from 0, without gaps in each shard) to every row.

    Rows are ordered by cell, hash of the key and id. Equal keys stay together as far as loads allow; null is a key like
    any other, and rows that repeat get slots of their own. An empty table gives no rows. Other columns stay, but for
    those called shard or slot. The rows are staged once, so give only the columns that are needed.
    """
    spark = docs.sparkSession
    hashed = without(docs, ["shard", "slot"]).withColumn("__hash", F.xxhash64(key))
    keyed = cut_lineage(hashed.withColumn("__cell", F.pmod("__hash", F.lit(CELLS)).cast("int")))
    cuts = F.ceil(F.count(F.lit(1)) / block_rows).alias("__cuts")
    cells = cut_lineage(keyed.groupBy("__cell").agg(cuts))  # CELLS rows at most
    block = F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.col("__cuts")).cast("int")
    keyed = keyed.join(F.broadcast(cells), "__cell").withColumn("__block", block).drop("__cuts")
    blocks = [tuple(r) for r in keyed.groupBy("__cell", "__block").count().collect()]
    names = "__cell int, __block int, __from bigint, __to bigint, shard int, __slot bigint"
    placed = spark.createDataFrame(place(blocks, shards, spare), names)
    numbered = keyed.selectExpr(
        "*", f"row_number() OVER (PARTITION BY __cell, __block ORDER BY __hash, `{id_col}`) - 1L AS __at"
    )
    joined = numbered.join(F.broadcast(placed), ["__cell", "__block"]).where("__at >= __from AND __at < __to")
    return joined.withColumn("slot", F.col("__slot") + F.col("__at") - F.col("__from")).drop(
        "__hash", "__cell", "__block", "__at", "__from", "__to", "__slot"
    )
