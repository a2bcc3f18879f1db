"""Hard negatives by a vertical scan of the dimensions (BOND).

Rows are cut into blocks that are kept dimension by dimension. For an anchor the dimensions of a block are read in
descending magnitude of the anchor's own components. Each adds to the rows' partial scores; what the unread ones can still
add is bounded by the smallest and largest value of each in the block. After every few dimensions the bitmap of candidates
loses the rows whose bounds say that they cannot be among the answers, and when all are read the partial scores of the rest
are exact.

Two scans are made: one for each anchor's positives (its nearest rows of the same label), and one for the rows of other
labels in a window of scores below each positive. Anchors are a stated set of rows and meet all rows in blocks; what leaves
a task is a few rows per anchor and block.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.storage import stored

#: Components in a block and in a group of anchors, on average: 2 MB and 16 MB as numbers of 8 bytes.
BLOCK_VALUES, ANCHOR_VALUES = 1 << 18, 1 << 21
#: Dimensions read between two looks at the bounds.
STRIDE = 8
#: Partitions of the scans at most; a task then has several blocks, one after another.
MOST_PARTITIONS = 20_000
LONG = (-(2**63), 2**63 - 1)


def number_type(block: np.ndarray, anchors: np.ndarray) -> type:
    """The fastest type in which no score or bound of these vectors is rounded or overflows."""
    largest = [max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0 for m in (block, anchors)]
    # A bound adds a partial score to what is left, and is compared with differences of bounds.
    most = 8 * largest[0] * largest[1] * max(1, block.shape[1])
    return np.float64 if most < 2**53 else np.int64 if most < 2**63 else object


class Block:
    """Rows sorted by label and id, dimension by dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.ranges: dict = {}

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))

    def extent(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest value of each dimension in a range of rows."""
        if (first, last) not in self.ranges:
            part = self.columns[:, first:last]
            self.ranges[first, last] = part.min(axis=1), part.max(axis=1)
        return self.ranges[first, last]


def vertical_scan(columns: np.ndarray, extent, anchor: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of the rows that are left when all dimensions are read.

    `keep(partial, low, high)` says which of the rows to go on with, when the unread dimensions add between low and high.
    """
    order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
    ends = np.stack([anchor * extent[0], anchor * extent[1]])[:, order]
    # What the dimensions from the k-th on can add; nothing after the last.
    low, high = (np.concatenate([np.cumsum(part[::-1])[::-1], part[:1] * 0]) for part in (ends.min(axis=0), ends.max(axis=0)))
    partial = np.zeros(len(alive), columns.dtype)
    whole = len(alive) == columns.shape[1]
    for at in range(0, len(order), STRIDE):
        for d in order[at : at + STRIDE].tolist():
            partial += anchor[d] * (columns[d] if whole else columns[d][alive])
        end = min(at + STRIDE, len(order))
        kept = keep(partial, low[end], high[end])
        if not kept.all():
            alive, partial, whole = alive[kept], partial[kept], False
        if not len(alive):
            break
    return alive, partial


def largest(values: np.ndarray, k: int):
    """The k-th largest of at least k values."""
    return np.partition(values, len(values) - k)[len(values) - k]


def nearest_rows(block: Block, anchor: np.ndarray, label: int, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of the label besides the anchor's own id, best first, ties to the smaller id."""
    first, last = block.of_label(label)
    if first == last:
        return block.ids[:0], block.columns[0, :0] if len(block.columns) else np.zeros(0)
    ids = block.ids[first:last]

    def keep(partial, low, high):
        if len(partial) <= k:
            return np.ones(len(partial), bool)
        return partial + high >= largest(partial, k) + low

    rows, scores = vertical_scan(block.columns[:, first:last], block.extent(first, last), anchor, np.flatnonzero(ids != own), keep)
    top = np.lexsort((ids[rows], -scores))[:k]
    return ids[rows][top], scores[top]


def rows_in_windows(
    block: Block, anchor: np.ndarray, label: int, own: int, windows: Sequence[tuple[int, int]], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per window (low, high) of scores, (ids, scores) of the k best rows of other labels in it."""
    first, last = block.of_label(label)
    other = np.ones(len(block.ids), bool)
    other[first:last] = False
    alive = np.flatnonzero(other & (block.ids != own))

    def keep(partial, low, high):
        kept = np.zeros(len(partial), bool)
        for least, most in windows:
            sure = partial[(partial + low >= least) & (partial + high <= most)]
            # k rows that are surely inside leave no place for a row that cannot reach the last of them.
            bound = least if len(sure) < k else max(least, largest(sure, k) + low)
            kept |= (partial + high >= bound) & (partial + low <= most)
        return kept

    out = []
    rows, scores = vertical_scan(block.columns, block.extent(0, len(block.ids)), anchor, alive, keep)
    ids = block.ids[rows]
    for least, most in windows:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        top = inside[np.lexsort((ids[inside], -scores[inside]))[:k]]
        out.append((ids[top], scores[top]))
    return out


def window_below(score: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """The whole numbers n with low_percent * score <= 100 * n <= high_percent * score; none if the first exceeds the second."""
    return -((-low_percent * score) // 100), (high_percent * score) // 100


def _parts(table: pa.Table, kind: type | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = table.column("vec").combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)
    return table.column("id").to_numpy(), table.column("label").to_numpy(), matrix if kind is None else matrix.astype(kind)


def _sides(data: pa.Table, asked: pa.Table):
    """The block, and (id, label, vector) of each anchor, in one exact type of numbers."""
    ids, labels, vectors = _parts(data)
    anchor_ids, anchor_labels, anchors = _parts(asked)
    kind = number_type(vectors, anchors)
    block = Block(ids, labels, vectors.astype(kind))
    return block, zip(anchor_ids.tolist(), anchor_labels.tolist(), anchors.astype(kind))


def _longs(found: list) -> pa.Array:
    """Whole numbers as longs; what lies beyond a long is moved to its end."""
    return pa.array([min(max(int(x), LONG[0]), LONG[1]) for part in found for x in part], pa.int64())


def _positives(data: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    anchors, ids, scores = [], [], []
    if len(data) and len(asked):
        block, asking = _sides(data, asked)
        for own, label, anchor in asking:
            found, values = nearest_rows(block, anchor, label, own, k)
            anchors.append([own] * len(found))
            ids.append(found.tolist())
            scores.append(values.tolist())
    return pa.table({"anchor_id": _longs(anchors), "positive_id": _longs(ids), "positive_score": _longs(scores)})


def _negatives(data: pa.Table, asked: pa.Table, k: int, low_percent: int, high_percent: int) -> pa.Table:
    out: list[list] = [[], [], [], [], []]
    if len(data) and len(asked):
        block, asking = _sides(data, asked)
        for (own, label, anchor), positives in zip(asking, asked.column("positives").to_pylist()):
            open_ = [(p, window_below(p["score"], low_percent, high_percent)) for p in positives]
            open_ = [(p, w) for p, w in open_ if w[0] <= w[1]]
            if not open_:
                continue
            for (p, _), (ids, values) in zip(open_, rows_in_windows(block, anchor, label, own, [w for _, w in open_], k)):
                row = [[own] * len(ids), [p["id"]] * len(ids), [p["score"]] * len(ids), ids.tolist(), values.tolist()]
                for column, values_ in zip(out, row):
                    column.append(values_)
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    return pa.table({name: _longs(column) for name, column in zip(names, out)})


def usable(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return vector.isNotNull() & finite


def mine_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
    block_values: int = BLOCK_VALUES, anchor_values: int = ANCHOR_VALUES,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    A component x becomes floor(scale * x), x as a double; what exceeds a long becomes the nearest long. A score is the inner
    product with the anchor, computed exactly; where it exceeds a long, the nearest long is returned. An anchor's positives
    are the best `positives` other rows of its label, and its negatives for each of them the best `negatives` rows of
    other labels whose score is between low_percent and high_percent of the positive's. Ties go to the smaller id.

    Rows without an id or a label, and vectors that are null or hold a null or non-finite component take no part; an empty
    vector scores 0 with other empty ones, and only vectors of one length are compared. Rows that repeat an id count as
    one, that of the smallest label, then the smallest vector. A label of any share is spread over all blocks. An empty
    table gives no rows; other columns are not read.
    """
    vec = F.col(vec_col).cast("array<double>")
    usable_rows = vectors.where(usable(vec) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.transform(vec, lambda x: F.floor(x * F.lit(float(scale))).cast("bigint")).alias("vec"), is_anchor.alias("asks"),
    )
    one = usable_rows.where("label is not null").groupBy("id").agg(F.min(F.struct("label", "vec", "asks")).alias("row"))
    rows = stored(one.select("id", "row.*", F.size("row.vec").alias("width")), "vectors")
    total = rows.agg(F.sum("width").alias("values"), F.sum(F.when(F.col("asks"), F.col("width"))).alias("asked")).first()
    blocks, groups = max(1, -(-(total["values"] or 0) // block_values)), max(1, -(-(total.asked or 0) // anchor_values))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")
    keys, n = ["width", "block", "group"], min(blocks * groups, MOST_PARTITIONS)

    def numbers(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def scan(asking: DataFrame, run, schema: str) -> DataFrame:
        # As many partitions as blocks: the work is in the scan, not in the bytes that AQE would merge small partitions by.
        data = rows.select("id", "label", "vec", "width", own.alias("block"), numbers(groups).alias("group"))
        asked = asking.select("*", numbers(blocks).alias("block"), group.alias("group"))
        sides = [side.repartition(n, *keys).groupBy(*keys) for side in (data, asked)]
        return sides[0].cogroup(sides[1]).applyInArrow(run, schema)

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        return _positives(left, right, positives)

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        return _negatives(left, right, negatives, low_percent, high_percent)

    anchors = rows.where("asks").select("id", "label", "vec", "width")
    near = scan(anchors, find_positives, "anchor_id bigint, positive_id bigint, positive_score bigint").selectExpr(
        "*", "row_number() OVER (PARTITION BY anchor_id ORDER BY positive_score DESC, positive_id) AS place"
    )
    best = near.where(F.col("place") <= positives).groupBy(F.col("anchor_id").alias("id"))
    best = best.agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    asking = stored(anchors.join(best, "id"), "anchors")
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    ranked = scan(asking, find_negatives, schema).selectExpr(
        "anchor_id", "positive_id",
        "row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS rank",
        "negative_id", "positive_score", "negative_score",
    )
    return ranked.where(F.col("rank") <= negatives)
