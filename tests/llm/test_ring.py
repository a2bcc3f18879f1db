import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quern.llm.queries import QUERIES
from quern.llm.ring import CELLS, capacities, place, shard_rows, virtual_nodes
from tests.llm.data import TEXTS, documents, prose


def plain_ring(keys, shards):
    """Rows of each shard by walking the ring one row at a time, nearest arcs first."""
    nodes = virtual_nodes(shards)
    cells = [c for c, _ in nodes]
    arc = {k: next((i for i, c in enumerate(cells) if c >= k), 0) for k in set(keys)}
    waiting = Counter(arc[k] for k in keys)
    free = capacities(len(keys), shards, 0.0)
    out, step = Counter(), 0
    while sum(waiting.values()):
        for a in sorted(waiting):
            shard = nodes[(a + step) % len(nodes)][1]
            while waiting[a] and free[shard]:
                waiting[a] -= 1
                free[shard] -= 1
                out[a, shard] += 1
        step += 1
    return out


def test_place_is_the_walk_round_the_ring():
    keys = [k * 7919 % CELLS for k in range(900)] + [1234] * 400
    blocks = [(cell, b, n) for cell, n in Counter(keys).items() for b, n in enumerate([n // 2, n - n // 2]) if n]
    placed = place(blocks, 5)
    nodes = virtual_nodes(5)
    arcs = {c: next((i for i, (v, _) in enumerate(nodes) if v >= c), 0) for c in set(keys)}
    got = Counter()
    slots = defaultdict(list)
    for cell, _, low, high, shard, slot in placed:
        got[arcs[cell], shard] += high - low
        slots[shard] += range(slot, slot + high - low)
    assert got == plain_ring(keys, 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def check(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_awkward_documents(spark):
    for block_rows in (1000, 2):
        docs = documents(spark, extra="'x' AS Shard")
        rows = shard_rows(docs, F.col("text"), 4, block_rows=block_rows).collect()
        assert len(rows) == len(TEXTS)
        check(rows, 4)
    assert shard_rows(documents(spark, []), F.col("text"), 4).count() == 0


def test_hot_key_overflows_clockwise_and_the_rest_stays_together(spark):
    rows = [(i, "hot") for i in range(300)] + [(1000 + i, prose(3, i % 50)) for i in range(600)]
    got = shard_rows(documents(spark, rows), F.col("text"), 8, block_rows=40).collect()
    check(got, 8)
    homes = defaultdict(set)
    for r in got:
        homes[r.text].add(r.shard)
    assert len(homes["hot"]) >= 3
    assert sum(len(s) == 1 for s in homes.values()) > 0.6 * len(homes)


def test_one_more_shard_moves_few_rows_with_spare_room(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(4000)])
    for spare, most in ((0.25, 0.25), (0.0, 0.6)):
        before = {r.doc_id: r.shard for r in shard_rows(docs, F.col("text"), 8, spare=spare).collect()}
        after = {r.doc_id: r.shard for r in shard_rows(docs, F.col("text"), 9, spare=spare).collect()}
        assert sum(before[i] != after[i] for i in before) < most * len(before)
        assert max(Counter(after.values()).values()) <= -(-4000 * (1 + spare) // 9)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op4_bounded_ring"](spark, sf).collect()
    check(rows, 24)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
