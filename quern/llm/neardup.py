"""Near duplicates by fast similarity sketches, banding, and exact confirmation on full shingle sets.

1. Every text becomes its set of word shingles. Texts with the same set form a class, named after its smallest id: a group
   of copies, however large, goes on as one row.
2. A sketch of each class (`sketches.py`) is cut into bands; classes that agree in a band share a bucket.
3. In a bucket of few classes all pairs are candidates. In a larger one a pivot is compared with the others, so a group of
   near copies costs about as many comparisons as it has members. The pivot is the class with the smallest share of
   shingles of its own, which in a group of copies with edits is the text that was edited. Classes outside the
   component of the pivot are then held against the classes of other components around the same pivot, block by block
   inside tasks, which hand on links alone. No possible link is skipped.
4. Candidates are confirmed on the full sets, and the links joined to components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.components import components
from quern.llm.sketches import band_hashes, band_shape, common, set_digest, shingle_sets, sketch_sets
from quern.llm.storage import stored
from quern.operators.skew import broadcast_if_small

#: Buckets up to this many classes are compared in full.
SMALL = 12
#: Sets of a block in the last pass.
BLOCK = 2000


def describe(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int, row_col: str) -> DataFrame:
    """doc_id, row_id, text_md5, n_shingles, digest (of the set) and bands (a hash each; null for an empty set)."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, sets in shingle_sets(batch.column(1), size):
                full = [i for i, s in enumerate(sets) if len(s)]
                hashes = band_hashes(sketch_sets([sets[i] for i in full], bands * rows), bands, rows)
                lists: list = [None] * len(sets)
                for k, i in enumerate(full):
                    lists[i] = hashes[k]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(sets)),
                        batch.column(2).slice(first, len(sets)),
                        batch.column(3).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "row_id", "text_md5", "n_shingles", "digest", "bands"],
                )

    text, doc_id, row_id = F.col(text_col).cast("string"), F.col(id_col).cast("bigint"), F.col(row_col).cast("bigint")
    source = docs.select(doc_id.alias("doc_id"), text.alias("text"), row_id.alias("row_id"), F.md5(text).alias("text_md5"))
    return source.mapInArrow(run, "doc_id bigint, row_id bigint, text_md5 string, n_shingles bigint, digest binary, bands array<bigint>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, size: int, nodes: DataFrame) -> DataFrame:
    """(node, items): the shingle set of each wanted document, as sorted 64-bit numbers."""

    def run(batches):
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), size):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "items"],
                )

    source = docs.select(F.col(id_col).cast("bigint").alias("node"), F.col(text_col).cast("string").alias("text"))
    return source.join(nodes, "node", "left_semi").mapInArrow(run, "node bigint, items binary")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Add `both`, the number of shared shingles, to the pairs (u, v, …)."""
    keep = pairs.columns
    left = sets.select(F.col("node").alias("u"), F.col("items").alias("u_items"))
    right = sets.select(F.col("node").alias("v"), F.col("items").alias("v_items"))
    wide = pairs.join(left, "u").join(right, "v").select(*keep, "u_items", "v_items")

    def run(batches):
        for batch in batches:
            us, vs = batch.column(len(keep)), batch.column(len(keep) + 1)
            both = [
                common(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64))
                for a, b in zip(us, vs)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(both, pa.int64())], names=[*keep, "both"])

    return wide.mapInArrow(run, ", ".join(f"{c} bigint" for c in [*keep, "both"]))


def _may_link(percent: int, n: str, n_2: str, shared: str | None = None, shared_2: str | None = None) -> Column:
    """Whether two sets can be similar enough: by their sizes, or by the most that they can have in common."""
    most = F.least(n, n_2) if shared is None else F.least(shared, shared_2)
    return most * 100 >= (F.col(n) + F.col(n_2) - most) * percent


def _is_link(percent: int) -> Column:
    return F.col("both") * 100 >= (F.col("n_u") + F.col("n_v") - F.col("both")) * percent


def _pair(a: str, b: str, n_a: str, n_b: str) -> list[Column]:
    first = F.col(a) < F.col(b)
    return [
        F.least(a, b).alias("u"),
        F.greatest(a, b).alias("v"),
        F.when(first, F.col(n_a)).otherwise(F.col(n_b)).alias("n_u"),
        F.when(first, F.col(n_b)).otherwise(F.col(n_a)).alias("n_v"),
    ]


def _all_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs within buckets of at most SMALL members."""
    other = members.select("bucket", F.col("node").alias("node_2"), F.col("n").alias("n_2"))
    pairs = members.join(other, "bucket").where("node < node_2").where(_may_link(percent, "n", "n_2"))
    return pairs.select(*_pair("node", "node_2", "n", "n_2"))


def _shared_sizes(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, shared): how many shingles of each node some other of the nodes has too."""

    def run(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            items = np.frombuffer(b"".join(raw), np.int64)
            owners = np.repeat(batch.column(0).to_numpy(), np.array([len(r) // 8 for r in raw], np.int64))
            for i in range(0, len(items), 1 << 16):
                part = [pa.array(c[i : i + (1 << 16)]) for c in (owners, items)]
                yield pa.RecordBatch.from_arrays(part, names=["node", "item"])

    wanted = sets.join(nodes, "node", "left_semi").select("node", "items")
    items = wanted.mapInArrow(run, "node bigint, item bigint")
    own = items.groupBy("item").agg(F.count(F.lit(1)).alias("holders"), F.min("node").alias("node")).where("holders = 1")
    counts = own.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    size = F.expr("octet_length(items) div 8")
    return wanted.join(counts, "node", "left").select("node", (size - F.coalesce("own", F.lit(0))).alias("shared"))


def _links_of_blocks(asking: pa.Table, others: pa.Table, percent: int) -> pa.Table:
    """Links from the asking sets to sets of another label, one for each label that is linked.

    An inverted index of one block counts, for one asking set at a time, what it shares with each set of the block.
    """
    u, v = [], []
    if len(asking) and len(others):
        raw = others.column("items").to_pylist()
        sizes = np.array([len(r) // 8 for r in raw])
        items = np.frombuffer(b"".join(raw), np.uint64)
        order = np.argsort(items, kind="stable")
        items, owners = items[order], np.repeat(np.arange(len(raw)), sizes)[order]
        nodes, labels = (others.column(c).to_numpy() for c in ("node", "label"))
        for node, label, blob in zip(*(asking.column(c).to_pylist() for c in ("node", "label", "items"))):
            own = np.frombuffer(blob, np.uint64)
            first, last = np.searchsorted(items, own), np.searchsorted(items, own, "right")
            counts = last - first
            steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            both = np.bincount(owners[np.repeat(first, counts) + steps], minlength=len(raw))
            linked = (both * 100 >= (len(own) + sizes - both) * percent) & (labels != label)
            found = np.flatnonzero(linked)
            for at in found[np.unique(labels[found], return_index=True)[1]]:
                u.append(node)
                v.append(int(nodes[at]))
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _search_blocks(named: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between the `outside` nodes of each pivot and its nodes of another label.

    Both sides are cut by hash into blocks of about BLOCK sets, and a task holds one block of each.
    """
    counts = named.groupBy("pivot").agg(F.count(F.lit(1)).alias("all"), F.count_if("outside").alias("asking"))
    cut = counts.where("asking > 0").select(
        "pivot", F.ceil(F.col("all") / BLOCK).alias("blocks"), F.ceil(F.col("asking") / BLOCK).alias("groups")
    )
    rows = named.join(cut, "pivot").join(sets, "node")

    def numbers(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    own, group = F.pmod(F.xxhash64("node"), "blocks"), F.pmod(F.xxhash64("node", F.lit(1)), "groups")
    def side(df: DataFrame, block: Column, part: Column) -> DataFrame:
        named = [F.col(c).alias(c) for c in ("pivot", "node", "label", "items")]
        return df.select(*named, block.alias("block"), part.alias("group"))

    asking = side(rows.where("outside"), numbers("blocks"), group)
    others = side(rows, own, numbers("groups"))
    keys = ["pivot", "block", "group"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _links_of_blocks(left, right, percent)

    return asking.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(run, "u bigint, v bigint")


def _with_pivots(members: DataFrame) -> DataFrame:
    """Add the pivot of each bucket: the member with the largest shared part, ties by a hash that differs by bucket."""
    order = F.struct(
        (-F.col("shared") / F.col("n")).alias("rank"), F.xxhash64("node", "bucket").alias("draw"), "node", "n", "shared"
    )
    best = members.groupBy("bucket").agg(F.min(order).alias("best"))
    pivots = best.select("bucket", *[F.col(f"best.{c}").alias(f"{c}_2") for c in ("node", "n", "shared")])
    return members.join(pivots, "bucket")


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Add label and label_2, the components of node and node_2."""
    for col in ("node", "node_2"):
        names = roots.select(F.col("node").alias(col), F.col("root").alias(f"root_{col}"))
        members = members.join(names, col, "left")
    return members.withColumn("label", F.coalesce("root_node", "node")).withColumn(
        "label_2", F.coalesce("root_node_2", "node_2")
    )


def link_classes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the components of the classes that share buckets: members (bucket, members, node, n)."""

    def star(rows: DataFrame) -> DataFrame:
        near = _may_link(percent, "n", "n_2", "shared", "shared_2")
        return rows.where("node <> node_2").where(near).select(*_pair("node", "node_2", "n", "n_2"))

    small, large = members.where(F.col("members") <= SMALL), members.where(F.col("members") > SMALL)
    # A set of which too little is shared can have no link in these buckets.
    shared = _shared_sizes(large.select("node").distinct(), sets)
    able = large.join(shared, "node").where(F.col("shared") * 100 >= F.col("n") * percent)
    columns = ["bucket", "node", "n", "shared"]
    stars = stored(_with_pivots(able.select(*columns)), "stars")
    pairs = _all_pairs(small, percent).union(star(stars)).distinct()
    roots = stored(components(compare(pairs, sets).where(_is_link(percent)).select("u", "v")), "roots")
    named = _labelled(stars, roots).groupBy(F.col("node_2").alias("pivot"), "node").agg(
        F.first("label").alias("label"), F.max(F.col("label") != F.col("label_2")).alias("outside")
    )
    links = stored(_search_blocks(stored(named, "named"), sets, percent), "links")
    if links.isEmpty():
        return roots
    return stored(components(links.union(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))), "roots")


def group_rows(
    docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, row_col: str | None = None
) -> DataFrame:
    """doc_id, row_id (of `row_col`), text_md5, n_shingles, digest, root and component_id of every row.

    The digest is null for a text without words, the root for a text with no link to another one; the component is null
    where no row of it has an id."""
    bands, rows = band_shape(percent / 100)
    info = stored(describe(docs, id_col, text_col, size, bands, rows, row_col or id_col), "described")
    classes = (
        info.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .where("node is not null")
    )
    entries = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = stored(entries.join(shared, "bucket").select("bucket", "members", "node", "n"), "members")
    nodes = stored(members.select("node").distinct(), "nodes")
    sets = stored(full_sets(docs, id_col, text_col, size, nodes), "sets")
    roots = link_classes(members, sets, percent)
    roots = roots.union(roots.select("root", "root").distinct())
    groups = (
        info.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .join(roots, "node", "left")
        .where("copies > 1 or root is not null")
        .select("digest", "root", F.coalesce("root", "node").alias("component"))
    )
    out = info.select("doc_id", "row_id", "text_md5", "n_shingles", "digest").join(groups, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "row_id", "text_md5", "n_shingles", "digest", "root", component.alias("component_id"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when their shingle sets of `size` words have a Jaccard similarity of `percent` / 100 or more;
    component_id is the smallest id that links lead to, and kept is true for the document that has it. A text that is
    null or has no words is linked with nothing. Rows that repeat an id count as one document: each is returned, and a
    text that any of them has links it. A row without an id belongs to the class of its text; if no row of the class has
    one, its component is null and it is kept. An empty table gives no rows. Columns other than the two are not read.
    """
    return group_rows(docs, id_col, text_col, size, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs without near duplicates: one row of each group, the one of the smallest id, then of the smallest
    digest of its text. Groups are those of `near_duplicates`, row by row: of one id's texts only the copies go, and copies
    without any id leave one. Rows that repeat in whole leave one too. Texts without words all stay.
    """
    text = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    # An id with several texts, or none, does not name a text; a hash of the text does then.
    by_id = text.groupBy("id").agg(F.min(F.md5("text")).alias("least"), F.max(F.md5("text")).alias("most"))
    odd = stored(by_id.where("least <> most or id is null").select(F.col("id").alias("odd")), "odd-ids")
    if odd.isEmpty():
        named = text.withColumn("text_id", F.col("id"))
    else:
        marked = text.join(broadcast_if_small(odd.withColumn("is_odd", F.lit(True))), F.col("id").eqNullSafe(F.col("odd")), "left")
        text_id = F.when(F.col("is_odd"), F.xxhash64(F.md5("text"))).otherwise(F.col("id")).alias("text_id")
        named = marked.select("id", "text", text_id)
    found = stored(group_rows(named, "text_id", "text", size, percent, "id").drop("doc_id").withColumnRenamed("row_id", "doc_id"), "grouped")
    group = F.coalesce(F.col("root").cast("string"), F.hex("digest")).alias("group")
    rows = found.where("digest is not null").groupBy(group, "doc_id", "text_md5").agg(F.count(F.lit(1)).alias("n"))
    best = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_md5", "n")).alias("row"))
    wordless = found.where("digest is null").select("doc_id", "text_md5", F.lit(1).cast("bigint").alias("n")).distinct()
    kept = stored(best.select("row.doc_id", "row.text_md5", "row.n").union(wordless), "kept")
    names = ["__id", "__md5", "__n"]
    marked = docs.withColumn("__text_md5", F.md5(F.col(text_col).cast("string")))
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")) & F.col("__text_md5").eqNullSafe(F.col("__md5"))
    out = marked.join(kept.toDF(*names), same)
    if not kept.where("n > 1").isEmpty():
        out = out.where("__n = 1").union(out.where("__n > 1").dropDuplicates([id_col, "__text_md5"]))
    return out.select(*docs.columns)
