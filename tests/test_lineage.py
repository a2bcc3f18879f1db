import random

import pytest
from pyspark.sql import functions as F

from quern.operators import lineage as G
from tests.conftest import rows_of


def edges(spark, pairs):
    return spark.createDataFrame(list(pairs), "source int, target int")


def nodes(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "node int")


def reach(pairs, start):
    out, todo, far = dict.fromkeys(start, 0), list(start), 0
    while todo:
        far += 1
        todo = sorted({b for a, b in pairs if a in todo} - out.keys())
        out.update(dict.fromkeys(todo, far))
    return out


def on_cycle(pairs):
    ends = {x for p in pairs for x in p}
    return sorted(n for n in ends if any(n in reach(pairs, [b]) for a, b in pairs if a == n))


CHAIN = [(i, i + 1) for i in range(1, 12)]
DIAMOND = [(20, 21), (20, 22), (21, 23), (22, 23), (20, 23)]
RING = [(30, 31), (31, 32), (32, 30), (32, 33), (29, 30)]
LOOP = [(40, 40), (40, 41)]
TWO_RINGS = [(50, 51), (51, 50), (51, 52), (52, 53), (53, 52), (53, 54), (49, 50), (51, 55), (55, 52)]


def test_downstream_and_upstream(spark):
    pairs = CHAIN + DIAMOND + RING
    assert dict(rows_of(G.downstream(edges(spark, pairs), nodes(spark, 1, 20, 31)))) == reach(pairs, [1, 20, 31])
    back = [(b, a) for a, b in pairs]
    assert dict(rows_of(G.upstream(edges(spark, pairs), nodes(spark, 12, 23)))) == reach(back, [12, 23])
    assert rows_of(G.downstream(edges(spark, pairs), nodes(spark, 99))) == [(99, 0)]


def test_cycles(spark):
    pairs = CHAIN + DIAMOND + RING + LOOP + TWO_RINGS
    assert [r[0] for r in rows_of(G.cycle_members(edges(spark, pairs)))] == on_cycle(pairs)
    assert G.cycle_members(edges(spark, CHAIN + DIAMOND)).isEmpty()


@pytest.mark.parametrize("seed", [3, 4])
def test_cycles_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    pairs = sorted({(rnd.randrange(30), rnd.randrange(30)) for _ in range(34)})
    assert sorted(r[0] for r in G.cycle_members(edges(spark, pairs)).collect()) == on_cycle(pairs)


def test_links_move_once_and_hubs_are_cut(spark):
    pairs = [(0, n) for n in range(1, 60)] + [(n, 100 + n) for n in range(1, 60)] + [(105, 200)]
    links = G.Links.of(edges(spark, pairs), limit=10)
    assert rows_of(links.hubs, "__hub") == [(0,)]
    start = spark.createDataFrame([(0, 0)], "node bigint, distance bigint")
    got = {r.node: r.distance for r in G._walk(links, start, "distance", F.min, 3).collect()}
    assert got == {0: 0, 200: 3} | {n: 1 for n in range(1, 60)} | {100 + n: 2 for n in range(1, 60)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain = G.Links.of(edges(spark, pairs))
        plan = G._walk(plain, G.cut_lineage(start), "distance", F.min, 4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange per hop, of what it reached, and one or two to begin with. The steps lie still.
    moved = [line for line in plan.splitlines() if "ENSURE_REQUIREMENTS" in line]
    assert 5 <= len(moved) <= 6 and not any("source" in line for line in moved)


def test_levels_are_longest_ways(spark):
    pairs = CHAIN + DIAMOND
    all_nodes = nodes(spark, *sorted({x for p in pairs for x in p}), 77)
    level = {r.node: r.level for r in G.layers(all_nodes, edges(spark, pairs)).collect()}
    assert level[1] == 0 and level[12] == 11 and level[23] == 2 and level[77] == 0
    assert all(level[a] < level[b] for a, b in pairs)


def test_levels_need_an_acyclic_graph(spark):
    for pairs in (RING, [(1, 2), (2, 1)]):
        with pytest.raises(ValueError, match="cycle"):
            G.layers(nodes(spark, *{x for p in pairs for x in p}), edges(spark, pairs))


def test_levels_of_a_long_chain(spark):
    pairs = [(n, n + 1) for n in range(60)]
    level = {r.node: r.level for r in G.layers(nodes(spark, *range(61)), edges(spark, pairs)).collect()}
    assert level == {n: n for n in range(61)}


def test_layer_names(spark):
    named = spark.createDataFrame([("stg_a",), ("int_b",), ("fct_c",)], "node string")
    links = spark.createDataFrame([("stg_a", "int_b"), ("int_b", "fct_c")], "source string, target string")
    assert rows_of(G.layers(named, links), "node", "layer", "level") == [
        ("fct_c", "mart", 2), ("int_b", "intermediate", 1), ("stg_a", "staging", 0),
    ]


@pytest.fixture
def project(spark):
    rows = [
        ("stg_orders", ["daily"], "models/staging/stg_orders.sql"),
        ("stg_users", [], "models/staging/stg_users.sql"),
        ("int_paid", ["daily"], "models/intermediate/int_paid.sql"),
        ("fct_revenue", ["core", "daily"], "models/marts/fct_revenue.sql"),
        ("dim_users", ["core"], "models/marts/dim_users.sql"),
    ]
    links = [("stg_orders", "int_paid"), ("int_paid", "fct_revenue"), ("stg_users", "dim_users")]
    return (
        spark.createDataFrame(rows, "node string, tags array<string>, path string"),
        spark.createDataFrame(links, "source string, target string"),
    )


def chosen(project, groups, exclude=()):
    return {r[0] for r in G.select_nodes(project[0], groups, exclude, project[1]).collect()}


def test_selection(project):
    term = G.Term
    assert len(chosen(project, [])) == 5
    assert chosen(project, [[term("name", "int_paid", upstream=True)]]) == {"stg_orders", "int_paid"}
    assert chosen(project, [[term("name", "stg_orders", downstream=True)]]) == {"stg_orders", "int_paid", "fct_revenue"}
    assert chosen(project, [[term("tag", "daily"), term("path", "models/marts")]]) == {"fct_revenue"}
    assert chosen(project, [[term("tag", "core")], [term("path", "models/staging/")]]) == {
        "fct_revenue", "dim_users", "stg_orders", "stg_users",
    }
    assert chosen(project, [], [[term("path", "models/marts")]]) == {"stg_orders", "stg_users", "int_paid"}
    assert chosen(project, [[term("name", "none")]]) == set()


def test_changed_nodes_and_what_depends_on_them(spark, project):
    old = spark.createDataFrame([("stg_orders", "1"), ("int_paid", "1"), ("stg_users", None), ("gone", "1")], "node string, hash string")
    new = spark.createDataFrame([("stg_orders", "1"), ("int_paid", "2"), ("stg_users", None), ("dim_users", "1")], "node string, hash string")
    out = G.changed_downstream(old, new, project[1])
    assert rows_of(out) == [("dim_users", 0), ("fct_revenue", 1), ("int_paid", 0)]


def test_a_node_with_most_edges(spark):
    pairs = [(0, i) for i in range(1, 400)] + [(i, 1000) for i in range(1, 400)] + [(1000, 1001)]
    found = G.downstream(edges(spark, pairs), nodes(spark, 0))
    assert rows_of(found.groupBy("distance").agg(F.count(F.lit(1)))) == [(0, 1), (1, 399), (2, 1), (3, 1)]


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    cut = G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    chain = spark.range(10_000).selectExpr("id AS source", "id + 1 AS target")
    found = G.downstream(chain, spark.range(1).selectExpr("id AS node"))
    assert len(rounds) <= 20
    assert found.count() == 10_001 and found.where("node <> distance").isEmpty()
    # A start inside the chain, and one of another type than the edges.
    found = G.downstream(chain.selectExpr("cast(source AS int) source", "cast(target AS int) target"), spark.range(5_000, 5_001).selectExpr("id AS node"))
    assert found.count() == 5_001 and found.where("node - 5000 <> distance").isEmpty()
    assert found.schema["node"].dataType.simpleString() == "bigint"


def test_long_rings_with_tails_and_inner_ways(spark):
    ring = [(i, (i + 1) % 300) for i in range(300)]
    tails = [(1000 + i, 1001 + i) for i in range(40)] + [(1040, 5), (17, 2000)] + [(2000 + i, 2001 + i) for i in range(40)]
    inner = [(10, 3000), (3000, 3001), (3001, 3002), (3002, 200), (10, 3100), (3100, 10), (50, 3200), (3200, 2010)]
    apart = [(4000 + i, 4000 + (i + 1) % 7) for i in range(7)] + [(5000, 5001), (5001, 5000)]
    pairs = ring + tails + inner + apart
    got = [r[0] for r in rows_of(G.cycle_members(edges(spark, pairs)))]
    assert sorted(got) == sorted(set(range(300)) | {3000, 3001, 3002, 3100} | set(range(4000, 4007)) | {5000, 5001})


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs_of_many_makes(spark, seed):
    """Sparse graphs with long ways, loops at one node, rings in rings, and many parts."""
    rnd = random.Random(seed)
    n = rnd.choice([12, 40, 90])
    pairs = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(int(n * rnd.choice([0.7, 1.0, 1.3])))}
    for a, b in list(pairs)[: n // 4]:
        way = [a, *[1000 * (a + 1) + 10 * b + k for k in range(rnd.randint(1, 6))], b]
        pairs |= set(zip(way, way[1:]))
    pairs = sorted(pairs)
    assert sorted(r[0] for r in G.cycle_members(edges(spark, pairs)).collect()) == on_cycle(pairs)
    start = [rnd.randrange(n) for _ in range(3)]
    assert dict(rows_of(G.downstream(edges(spark, pairs), nodes(spark, *start)))) == reach(pairs, start)


@pytest.mark.parametrize("seed", range(2))
def test_longest_ways_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    pairs = sorted({tuple(sorted(rnd.sample(range(40), 2))) for _ in range(50)} | {(k, k + 1) for k in range(50, 75)} | {(3, 50), (75, 90)})
    level = dict.fromkeys({x for p in pairs for x in p}, 0)
    for a, b in sorted(pairs, key=lambda p: p[0]):
        level[b] = max(level[b], level[a] + 1)
    got = {r.node: r.level for r in G.layers(nodes(spark, *level), edges(spark, pairs)).collect()}
    assert got == level
