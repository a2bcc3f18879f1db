"""The trie of conversation prefixes, by digests of blocks of turns.

1. Every turn gets a number along its conversation and a digest of its role and text; texts go no further.
2. A block is a fixed number of turns. Its digest is the sum of hashes of its turns' places and digests, and the running sum
   over a conversation's blocks names everything said up to the end of a block. Sums can be put together in any order, so a
   conversation of any length is cut over tasks.
3. Conversations are grouped by these names. Where all that share a block's beginning share the whole block, the block is
   one chain of nodes and its inner turns are looked at for one member only.
4. Only blocks in which siblings diverge are refined: their turns get running sums of their own, and each turn is a group.

A node is known by its smallest member and its depth. A member that is the smallest at one depth is so at all later depths
of its own, so what hangs below a node is the sum of what its members own, less what its smallest member owns above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.storage import stored
from quern.operators.skew import GROUP_LIMIT
from quern.operators.windows import add_row_number, add_running_sum

#: Turns in a block.
BLOCK_TURNS = 4
SUM = "decimal(38,0)"
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn; its role and text cannot run into one another, as the role's length comes first."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def placed_hashes(place: Column | str, digest: Column | str) -> list[Column]:
    """Two hashes of a turn at its place, whose sums over the turns of a prefix name the prefix."""
    return [F.xxhash64(F.lit(seed), place, digest, F.lit(seed)).cast(SUM).alias(name) for seed, name in ((1, "h"), (2, "g"))]


def numbered_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """conv_id, place (from 1), digest and bytes of every turn, by turn (null first); ties go by the turn's digest."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    slim = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
        turn_digest(role, text).alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"),
    )
    numbered = add_row_number(slim, ["conv_id"], ["turn", "digest"], "place", limit)
    return numbered.select("conv_id", F.col("place").cast("bigint").alias("place"), "digest", "bytes")


def conversation_trie(
    turns: DataFrame, conversations: DataFrame, block_turns: int = BLOCK_TURNS, limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `turns` has conv_id, place (1, 2, 3 … in each conversation), digest and bytes; `conversations` has every conv_id once,
    also those without a turn. conv_id is the node's smallest member, depth the number of its turns, and the root has depth
    0. n_leaves and saved_tokens are over the node's subtree, itself included; ends_sha256 is of the ids, ascending and joined by
    commas, of the members that end at the node. No conversation gives no rows, not even a root.

    A node may have any share of the members: they are counted before they are moved. The digest of a node's ends is one
    value over one sequence, so one task reads these ids, sorted, and keeps none of them.
    """
    block = F.floor((F.col("place") - 1) / block_turns).cast("bigint")
    turns = stored(turns.select("conv_id", "place", "bytes", block.alias("block"), *placed_hashes("place", "digest")), "turns")
    per_block = turns.groupBy("conv_id", "block").agg(
        F.sum("h").alias("h"), F.sum("g").alias("g"), F.max("place").alias("last")
    )
    running = add_running_sum(per_block, ["conv_id"], ["block"], "h", "h_after", limit)
    running = add_running_sum(running, ["conv_id"], ["block"], "g", "g_after", limit)
    zero = F.lit(0).cast(SUM)
    blocks = running.select(
        "conv_id", "block", "last",
        (F.col("h_after") - F.col("h")).alias("h_before"), (F.col("g_after") - F.col("g")).alias("g_before"),
        F.col("h_after").cast(SUM).alias("h_after"), F.col("g_after").cast(SUM).alias("g_after"),
    )
    # A conversation without turns has no block; the root is the end of a block before the first.
    roots = conversations.select(
        "conv_id", F.lit(-1).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("last"),
        *[zero.alias(c) for c in ("h_before", "g_before", "h_after", "g_after")],
    )
    blocks = stored(blocks.unionByName(roots).withColumns({c: F.col(c).cast(SUM) for c in ("h_before", "g_before")}), "blocks")
    start, end = ["block", "h_before", "g_before"], ["block", "h_after", "g_after"]
    whole = blocks.groupBy(*start, "h_after", "g_after").agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.max("last").alias("last")
    )
    whole = stored(whole, "block-groups")
    siblings = whole.groupBy(*start).agg(F.count(F.lit(1)).alias("siblings"))
    diverging = stored(siblings.where("siblings > 1").select(*start), "diverging")

    # Blocks that all who reach them share: a chain, read from the smallest member.
    shared = whole.join(diverging, start, "left_anti")
    chains = shared.select(F.col("rep").alias("conv_id"), "block", "n")
    chain_nodes = turns.select("conv_id", "block", "place", "bytes").join(chains, ["conv_id", "block"]).select(
        F.col("conv_id").alias("rep"), F.col("place").alias("depth"), "n", "bytes"
    )
    root = whole.where("block = -1").select("rep", F.lit(0).cast("bigint").alias("depth"), "n", F.lit(0).cast("bigint").alias("bytes"))
    # Blocks in which siblings diverge: each turn is a group of its own.
    torn = blocks.join(diverging, start, "left_semi").select("conv_id", *start)
    inner = turns.join(torn, ["conv_id", "block"])
    for name in ("h", "g"):
        inner = add_running_sum(inner, ["conv_id", "block"], ["place"], name, f"{name}_here", None)
    above = {f"{c}_above": (F.col(f"{c}_before") + F.col(f"{c}_here") - F.col(c)).cast(SUM) for c in ("h", "g")}
    prefix = {c: (F.col(f"{c}_above") + F.col(c)).cast(SUM) for c in ("h", "g")}
    inner = inner.withColumns(above).withColumns(prefix)
    inner = stored(inner.select("conv_id", F.col("place").alias("depth"), "bytes", "h", "g", *above), "refined-turns")
    by_turn = ["depth", "h", "g"]
    refined = inner.groupBy(*by_turn).agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n"), *[F.max(c).alias(c) for c in ("bytes", *above)]
    )
    refined = stored(refined, "refined")
    nodes = chain_nodes.unionByName(refined.select("rep", "depth", "n", "bytes")).unionByName(root)

    # Every named prefix with its smallest member: the ends of blocks, and the turns of the refined ones.
    block_ends = whole.select(F.col("last").alias("depth"), F.col("h_after").alias("h"), F.col("g_after").alias("g"), "rep")
    reached = block_ends.unionByName(refined.select(*by_turn, "rep")).groupBy(*by_turn).agg(F.min("rep").alias("rep"))
    reached = stored(reached, "prefixes")
    # A chain hangs from the prefix before its block, a refined turn from the prefix before it.
    hung = shared.where("block >= 0").select(
        F.col("rep").alias("child"), (F.col("block") * block_turns).alias("depth"), F.col("h_before").alias("h"), F.col("g_before").alias("g")
    )
    hung = hung.unionByName(
        refined.select(F.col("rep").alias("child"), (F.col("depth") - 1).alias("depth"), F.col("h_above").alias("h"), F.col("g_above").alias("g"))
    )
    links = hung.join(reached, by_turn).select(
        F.col("child").alias("rep"), (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent")
    )
    # Inside a chain the parent has the same smallest member.
    tree = nodes.join(links, ["rep", "depth"], "left").withColumn(
        "parent", F.when(F.col("depth") > 0, F.coalesce("parent", "rep"))
    )
    children = tree.where("depth > 0").groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    own = (F.col("n") - 1) * F.col("bytes")
    tree = stored(
        tree.join(children, ["rep", "depth"], "left")
        .select("rep", "depth", "n", "parent", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), own.alias("own")),
        "tree",
    )

    # What each conversation owns, summed over the members of every group.
    owned = tree.groupBy(F.col("rep").alias("conv_id")).agg(
        F.sum("own").alias("owned"), F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaf")
    )
    owned = stored(owned, "owned")

    def below(members: DataFrame, by: Sequence[str]) -> DataFrame:
        kept = members.join(owned, "conv_id", "left")
        return kept.groupBy(*by).agg(F.min("conv_id").alias("rep"), F.sum("owned").alias("below"), F.sum("leaf").alias("leaves"))

    chain_below = below(blocks.select("conv_id", *end), end).join(shared.select("rep", "block"), ["rep", "block"], "left_semi")
    chain_below = chain_below.select("rep", "block", "below", "leaves")
    turn_below = below(inner.select("conv_id", *by_turn), by_turn).select("rep", "depth", "below", "leaves")
    numbered = tree.withColumn("block", F.floor((F.col("depth") - 1) / block_turns).cast("bigint"))
    totals = numbered.join(chain_below, ["rep", "block"]).unionByName(
        numbered.join(turn_below, ["rep", "depth"]).select(*numbered.columns, "below", "leaves")
    )
    held = add_running_sum(totals, ["rep"], ["depth"], "own", "upto", limit)

    # Members that end at a node: those whose last block ends there.
    lasts = blocks.groupBy("conv_id").agg(F.max_by(F.struct("last", "h_after", "g_after"), "block").alias("end"))
    ends = lasts.select("conv_id", F.col("end.last").alias("depth"), F.col("end.h_after").alias("h"), F.col("end.g_after").alias("g"))
    ends = ends.join(reached, by_turn).select("rep", "depth", "conv_id")
    return held.join(ends_digests(ends), ["rep", "depth"], "left").select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").cast("bigint").alias("n_leaves"),
        (F.col("below") - F.col("upto") + F.col("own")).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def ends_digests(ends: DataFrame) -> DataFrame:
    """(rep, depth, ends_sha256) of ends (rep, depth, conv_id): the ids in ascending order, joined by commas.

    The sorted ids of a node stream through one hash, whatever their number.
    """

    def run(batches):
        key, state, done = None, None, []
        for batch in batches:
            for rep, depth, conv in zip(*(column.to_pylist() for column in batch.columns)):
                if (rep, depth) == key:
                    state.update(b",%d" % conv)
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (rep, depth), hashlib.sha256(b"%d" % conv)
            if done:
                yield as_batch(done)
                done = []
        if key:
            yield as_batch([(*key, state.hexdigest())])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(columns, names=["rep", "depth", "ends_sha256"])

    sorted_ends = ends.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "conv_id")
    return sorted_ends.mapInArrow(run, "rep bigint, depth bigint, ends_sha256 string")
