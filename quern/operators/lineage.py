"""Walks over an edge table (source, target).

Ways without branches are taken as one step. Their nodes, with one edge in and one out, find the node that their way begins
with by pointer doubling: each learns what is twice as far ahead as in the round before, so a way of any length takes the
logarithm of it in rounds. A ring of such nodes is told by a node that meets itself.

On what is left each round goes several hops in one job and writes what it found to the checkpoint folder, so plans stay short
and a lost executor costs one round at most. Only nodes reached anew, or in a better way, are expanded in the next round. The
edges are laid out by their source once per walk and stay where they are; a hop moves the nodes reached so far. The edges of a
node with very many of them are laid out in several parts, and that node is sent to each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.skew import GROUP_LIMIT, hot_keys, parts_for, salt_of
from quern.session import written as cut_lineage

HOPS = 8
# Doublings that one job does.
DOUBLINGS = 3
# Edges in a partition of the layout.
EDGE_ROWS = 1_000_000
# Layers of end nodes that one job takes off.
PEELS = 2


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def reverse(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("target").alias("source"), F.col("source").alias("target"))


def _ends(edges: DataFrame) -> DataFrame:
    """Every node with whether an edge enters and leaves it. Tasks combine their nodes first, so a node with very many
    edges is one row per task."""
    source = F.struct(F.col("source").alias("node"), F.lit(0).alias("enters"), F.lit(1).alias("leaves"))
    target = F.struct(F.col("target").alias("node"), F.lit(1).alias("enters"), F.lit(0).alias("leaves"))
    both = edges.select(F.explode(F.array(source, target)).alias("end")).select("end.*")
    return both.groupBy("node").agg(F.max("enters").alias("enters"), F.max("leaves").alias("leaves"))


def _with_self(edges: DataFrame) -> DataFrame:
    """Edges as steps (of length 1, if they have no step of their own), and each node to itself with length 0, so that one
    join both moves on and keeps what is there."""
    nodes = _ends(edges).select(F.col("node").alias("source"), F.col("node").alias("target"))
    length = F.col("step") if "step" in edges.columns else F.lit(1)
    one, none = length.cast("bigint").alias("step"), F.lit(0).cast("bigint").alias("step")
    return cut_lineage(edges.select("source", "target", one).unionByName(nodes.select("source", "target", none)))


def _default_partitions(spark: SparkSession) -> int:
    """How many partitions Spark begins a shuffle with; joins go by the side that has more."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class Links:
    """Steps (source, target, step) laid out by source; `hubs` has the nodes that are cut, with their number of parts."""

    steps: DataFrame
    hubs: DataFrame | None

    @classmethod
    def of(cls, edges: DataFrame, limit: int = GROUP_LIMIT) -> Links:
        links = _with_self(edges)
        hubs = cut_lineage(hot_keys(links, ["source"], limit))
        salts = F.ceil(F.col("__rows") / F.lit(limit)).cast("int").alias("__salts")
        hubs = None if hubs.isEmpty() else hubs.select(F.col("source").alias("__hub"), salts)
        parts = parts_for(links, EDGE_ROWS, _default_partitions(links.sparkSession))
        if hubs is None:
            laid = links.repartition(parts, "source")
        else:
            # At most rows / limit hubs.
            marked = links.join(F.broadcast(hubs), F.col("source") == F.col("__hub"), "left")
            salted = marked.withColumn("__salt", salt_of(["target"], F.coalesce("__salts", F.lit(1))))
            laid = salted.select("source", "__salt", "target", "step").repartition(parts, "source", "__salt")
        kept = laid.persist(StorageLevel.DISK_ONLY)
        kept.count()  # a plan over it knows the layout only once it is there
        return cls(kept, hubs)

    def nodes(self) -> DataFrame:
        return self.steps.where("step = 0").select(F.col("source").alias("node"))

    def follow(self, layer: DataFrame) -> DataFrame:
        """The steps out of the layer's nodes, next to the layer's columns."""
        if self.hubs is None:
            return self.steps.join(layer, F.col("source") == F.col("node"))
        marked = layer.join(F.broadcast(self.hubs), F.col("node") == F.col("__hub"), "left")
        copies = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
        sent = marked.withColumn("__sent", F.explode(copies)).drop("__hub", "__salts")
        return self.steps.join(sent, (F.col("source") == F.col("node")) & (F.col("__salt") == F.col("__sent")))

    def drop(self) -> None:
        self.steps.unpersist()


def _walk(links: Links, layer: DataFrame, value: str, best: Callable, hops: int) -> DataFrame:
    """Follow the edges `hops` times from (node, value): the best value + steps per node reached, and the first hop (from 1)
    that gave it."""
    sign = -1 if best is F.max else 1
    kind = links.steps.schema["source"].dataType
    # A key of another type would have the steps moved at every hop.
    layer = layer.select(F.col("node").cast(kind).alias("node"), value, F.lit(0).alias("hop"))
    for n in range(1, hops + 1):
        hop = F.when(F.col("step") == 0, F.col("hop")).otherwise(F.lit(n * sign)).alias("hop")
        moved = links.follow(layer).select(F.col("target").alias("node"), (F.col(value) + F.col("step")).alias(value), hop)
        layer = moved.groupBy("node").agg(best(F.struct(value, "hop")).alias("b")).select("node", f"b.{value}", "b.hop")
    return layer.withColumn("hop", F.abs("hop"))


def _spread(links: Links, start: DataFrame, value: str, best: Callable, hops: int) -> DataFrame:
    """The best value of every node that ways from the start nodes (node, value) lead to, these included."""
    frontier = cut_lineage(start.select("node", value))
    # Few hops first: with ways as single steps many walks end after one or two.
    reached, ahead = [frontier], min(2, hops)
    while not frontier.isEmpty():
        near = _walk(links, frontier, value, best, ahead)
        former = _union(reached).groupBy("node").agg(best(value).alias("__former"))
        better = F.col(value) > F.col("__former") if best is F.max else F.col(value) < F.col("__former")
        fresh = near.join(former, "node", "left").where(F.col("__former").isNull() | better)
        fresh = cut_lineage(fresh.select("node", value, "hop"))
        reached.append(fresh.select("node", value))
        # Nodes that an earlier hop gave their value were expanded in this round already.
        frontier, ahead = fresh.where(F.col("hop") == ahead).select("node", value), min(2 * ahead, hops)
    return _union(reached).groupBy("node").agg(best(value).alias(value))


@dataclass(frozen=True)
class Ways:
    """A graph with its unbranched ways as single steps.

    `links` (source, target, step) go between the other nodes; `chains` (node, head, first, position) has the nodes on the
    ways, at their distance from the node the way begins with, `first` being the way's own first node; `tails` (first, head,
    tail) says where a way ends; `rings` (node, label) has the nodes of rings without a branch, with the smallest node of
    each.
    """

    links: DataFrame
    chains: DataFrame
    tails: DataFrame
    rings: DataFrame


def _double(state: DataFrame) -> DataFrame:
    """Let every node that is under way point to where the node it points to points."""
    ahead = state.select(F.col("node").alias("ahead"), *[F.col(c).alias(f"__{c}") for c in ("ahead", "first", "steps", "least", "done")])
    moved = state.where("not done").join(ahead, "ahead").select(
        "node", F.col("__ahead").alias("ahead"), F.col("__first").alias("first"), (F.col("steps") + F.col("__steps")).alias("steps"),
        F.least("least", "__least").alias("least"), F.col("__done").alias("done"),
    )
    return state.where("done").unionByName(moved)


def contract(edges: DataFrame, keep: DataFrame | None = None, best: Callable = F.min) -> Ways | None:
    """Take ways without branches as single steps; of several between two nodes the best one. Nodes in `keep` end a way. None
    if there is no node to take away."""
    one, none = F.lit(1).alias("ins"), F.lit(0).alias("ins")
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("source").alias("node"), none, F.lit(1).alias("outs")), F.struct(F.col("target").alias("node"), one, F.lit(0).alias("outs"))
    )).alias("end")).select("end.*")
    inner = ends.groupBy("node").agg(F.sum("ins").alias("ins"), F.sum("outs").alias("outs")).where("ins = 1 and outs = 1").select("node")
    if keep is not None:
        inner = inner.join(keep.select("node"), "node", "left_anti")
    inner = cut_lineage(inner)
    if inner.isEmpty():
        return None
    entered = edges.join(inner.withColumnRenamed("node", "target"), "target")
    under_way = inner.select(F.col("node").alias("source"), F.lit(False).alias("__done"))
    state = entered.join(under_way, "source", "left").select(
        F.col("target").alias("node"), F.col("source").alias("ahead"),
        F.when(F.col("__done").isNull(), F.col("target")).otherwise(F.col("source")).alias("first"), F.lit(1).cast("bigint").alias("steps"),
        F.col("source").alias("least"), F.coalesce("__done", F.lit(True)).alias("done"),
    )
    rings = []
    while True:
        for _ in range(DOUBLINGS):
            state = _double(state)
        state = cut_lineage(state)
        going = state.where("not done")
        if going.isEmpty():
            break
        # The smallest node of a ring that has come round to itself, and with it all nodes of the ring.
        closed = going.where("node = least").select("least")
        rings.append(going.join(closed, "least", "left_semi").select("node", F.col("least").alias("label")))
        state = state.join(closed, "least", "left_anti")
    chains = state.select("node", F.col("ahead").alias("head"), "first", F.col("steps").alias("position"))
    left = edges.join(inner.withColumnRenamed("node", "target"), "target", "left_anti")
    left = left.join(chains.withColumnRenamed("node", "source"), "source", "left")
    left = cut_lineage(left)
    tails = left.where("first is not null").select("first", "head", F.col("target").alias("tail"))
    links = left.groupBy(F.coalesce("head", "source").alias("source"), "target").agg(
        best(F.coalesce("position", F.lit(0).cast("bigint")) + 1).alias("step")
    )
    none = inner.where("false").select("node", F.col("node").alias("label"))
    return Ways(links, chains, tails, _union([none, *rings]))


def _plain(edges: DataFrame, start: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Different edges without nulls, and the start nodes, of one type."""
    kept = edges.select("source", "target").dropna().distinct()
    if start is None:
        return kept, None
    kind = kept.select("source").union(kept.select("target")).union(start.select("node")).schema["source"].dataType
    first = start.select(F.col("node").cast(kind).alias("node")).distinct()
    return kept.select(*[F.col(c).cast(kind).alias(c) for c in ("source", "target")]), first


def downstream(edges: DataFrame, start: DataFrame, hops: int = HOPS) -> DataFrame:
    """The start nodes and everything reachable from them: (node, distance). A way without branches takes as many rounds as
    its length has binary digits, and no hop after that."""
    plain, first = _plain(edges, start)
    plain, first = cut_lineage(plain), cut_lineage(first.where("node is not null"))
    ways = contract(plain, first)
    links = Links.of(ways.links if ways else plain)
    reached = _spread(links, first.withColumn("distance", F.lit(0).cast("bigint")), "distance", F.min, hops)
    reached = cut_lineage(reached)
    links.drop()
    if not ways:
        return reached
    heads = reached.select(F.col("node").alias("head"), "distance")
    on_ways = ways.chains.join(heads, "head").select("node", (F.col("distance") + F.col("position")).alias("distance"))
    return reached.unionByName(on_ways)


def upstream(edges: DataFrame, start: DataFrame, hops: int = HOPS) -> DataFrame:
    """The start nodes and everything they are reachable from."""
    return downstream(reverse(edges), start, hops)


def _without(edges: DataFrame, gone: DataFrame) -> DataFrame:
    """Edges that touch none of the nodes."""
    kept = edges.join(gone.select(F.col("node").alias("source")), "source", "left_anti")
    return kept.join(gone.select(F.col("node").alias("target")), "target", "left_anti").select("source", "target")


def _trim(edges: DataFrame, peels: int = PEELS) -> DataFrame:
    """Drop nodes that no edge enters or none leaves, until there are none: they cannot lie on a cycle.

    Several layers are peeled in one job, and counting what is left says when to stop.
    """
    edges = cut_lineage(edges)
    left = edges.count()
    while left:
        for _ in range(peels):
            edges = _without(edges, _ends(edges).where("enters + leaves < 2").select("node"))
        edges, before = cut_lineage(edges), left
        left = edges.count()
        if left == before:
            break
    return edges


def _spread_largest(edges: DataFrame, hops: int) -> DataFrame:
    """Every node with the largest node that reaches it (itself included)."""
    links = Links.of(edges)
    labels = cut_lineage(links.nodes().withColumn("label", F.col("node")))
    changed = labels
    while not changed.isEmpty():
        step = changed
        for _ in range(hops):
            sent = links.follow(step).select(F.col("target").alias("node"), "label")
            step = sent.groupBy("node").agg(F.max("label").alias("label"))
        # Only nodes with a new label send it on.
        former = labels.withColumnRenamed("label", "__former")
        changed = cut_lineage(step.join(former, "node").where("label > __former").select("node", "label"))
        labels = cut_lineage(labels.unionByName(changed).groupBy("node").agg(F.max("label").alias("label")))
    links.drop()
    return labels


def _parts_of_cycles(core: DataFrame, hops: int) -> DataFrame:
    """(node, label) of the nodes of strongly connected parts of two nodes or more, by their largest node.

    Every node learns the largest node that reaches it; the nodes of one label that reach back the node that gave it are
    one part. All labels are searched at once. What is not in a part found so is treated again.
    """
    found = [core.where("false").select(F.col("source").alias("node"), F.col("source").alias("label"))]
    while not core.isEmpty():
        labels = _spread_largest(core, hops)
        src = labels.select(F.col("node").alias("source"), F.col("label").alias("__s"))
        dst = labels.select(F.col("node").alias("target"), F.col("label").alias("__t"))
        same = core.join(src, "source").join(dst, "target").where("__s = __t").select("source", "target")
        roots = labels.where("node = label").select("node")
        # Only edges between nodes of one label are followed, so each root finds the nodes of its own part.
        part = cut_lineage(upstream(same, roots).select("node").join(labels, "node"))
        sizes = part.groupBy("label").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        found.append(part.join(sizes, "label", "left_semi").select("node", "label"))
        core = _trim(_without(core, part))
    return _union(found)


def _on_ways(ways: Ways, known: DataFrame) -> DataFrame:
    """(node, label) of the nodes on ways that begin and end in one part (node, label), or in one node."""
    begins, ends = (known.select(F.col("node").alias(c), F.col("label").alias(f"__{c}")) for c in ("head", "tail"))
    closed = ways.tails.join(begins, "head", "left").join(ends, "tail", "left").where("head = tail or __head = __tail")
    closed = closed.select("first", "head", F.coalesce("__head", "head").alias("label"), F.col("__head").isNull().alias("new"))
    nodes = ways.chains.join(closed.select("first", "label"), "first").select("node", "label")
    return nodes.unionByName(closed.where("new").select(F.col("head").alias("node"), "label").distinct())


def cycle_members(edges: DataFrame, hops: int = HOPS) -> DataFrame:
    """Nodes that lie on a cycle.

    Ways without branches become single steps, which finds all rings without a branch, and then ends are trimmed; both are
    repeated while they take nodes away. What is left is divided into strongly connected parts. A node on a way lies on a
    cycle if the way goes from a part back into it, or to where it began. No list of pairs is ever built.
    """
    plain, _ = _plain(edges)
    members = [plain.where("source = target").select(F.col("source").alias("node"))]
    core = cut_lineage(plain.where("source <> target"))
    labels, levels = [], []
    while not core.isEmpty():
        ways = contract(core)
        if ways is None:
            break
        levels.append(ways)
        labels.append(ways.rings)
        core = _trim(ways.links.where("source <> target").select("source", "target"))
    labels.append(_parts_of_cycles(core, hops))
    known = cut_lineage(_union(labels))
    for ways in reversed(levels):
        known = cut_lineage(known.unionByName(_on_ways(ways, known)))
    return _union([*members, known.select("node")]).distinct()


def layers(nodes: DataFrame, edges: DataFrame, hops: int = HOPS) -> DataFrame:
    """Every node with its layer by name (`stg_` staging, `int_` intermediate, otherwise mart) and its level: the
    longest way from a node without parents. A graph with a cycle has no levels and is an error; one without may be as
    deep as it likes."""
    plain, every = _plain(edges, nodes)
    plain = cut_lineage(plain)
    ways = contract(plain, best=F.max)
    links = ways.links if ways else plain
    if not _trim(links.select("source", "target")).isEmpty() or (ways and not ways.rings.isEmpty()):
        raise ValueError("the graph has a cycle; cycle_members finds it")
    laid = Links.of(links)
    roots = every.join(plain.select(F.col("target").alias("node")), "node", "left_anti")
    level = cut_lineage(_spread(laid, roots.withColumn("level", F.lit(0).cast("bigint")), "level", F.max, hops))
    laid.drop()
    if ways:
        heads = level.select(F.col("node").alias("head"), "level")
        level = level.unionByName(ways.chains.join(heads, "head").select("node", (F.col("level") + F.col("position")).alias("level")))
    name = F.col("node").cast("string")
    layer = (
        F.when(name.startswith("stg_"), F.lit("staging"))
        .when(name.startswith("int_"), F.lit("intermediate"))
        .otherwise(F.lit("mart"))
    )
    return every.join(level, "node", "left").withColumn("layer", layer)


@dataclass(frozen=True)
class Term:
    """Part of a selection: method 'name', 'tag' or 'path', a value, and whether to add parents or children."""

    method: str
    value: str
    upstream: bool = False
    downstream: bool = False

    def nodes(self, nodes: DataFrame, edges: DataFrame | None) -> DataFrame:
        if self.method == "name":
            hit = F.col("node") == self.value
        elif self.method == "tag":
            hit = F.array_contains("tags", self.value)
        elif self.method == "path":
            folder = self.value.rstrip("/") + "/"
            hit = (F.col("path") == self.value) | F.col("path").startswith(folder)
        else:
            raise ValueError(f"method {self.method!r} is not name, tag or path")
        base = nodes.where(hit).select("node")
        parts = [base]
        if self.upstream:
            parts.append(upstream(edges, base).select("node"))
        if self.downstream:
            parts.append(downstream(edges, base).select("node"))
        return _union(parts).distinct()


def select_nodes(
    nodes: DataFrame,
    groups: Sequence[Sequence[Term]],
    exclude: Sequence[Sequence[Term]] = (),
    edges: DataFrame | None = None,
) -> DataFrame:
    """Union of the groups, each the intersection of its terms, minus the excluded groups. No group selects all."""

    def either(some: Sequence[Sequence[Term]]) -> DataFrame:
        each = [reduce(lambda a, b: a.intersect(b), [t.nodes(nodes, edges) for t in group]) for group in some if group]
        return _union(each).distinct()

    chosen = either(groups) if groups else nodes.select("node").distinct()
    return chosen.subtract(either(exclude)) if exclude else chosen


def changed_downstream(old: DataFrame, new: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that are new or whose definition hash differs from a saved state, and all that depends on them."""
    saved = old.select(F.col("node").alias("__node"), F.col("hash").alias("__hash"))
    same = (F.col("node") == F.col("__node")) & F.col("hash").eqNullSafe(F.col("__hash"))
    changed = new.join(saved, same, "left_anti").select("node")
    return downstream(edges, changed)
