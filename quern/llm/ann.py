"""Nearest neighbours by a hash-prefix forest.

Every tree hashes a vector to a string of bits, the signs of its products with rotated axes, and keeps the strings sorted.
A query descends by binary search to the strings that share its longest prefix, and then ascends in all trees at once, one
bit shorter at a time, until the ranges hold enough different rows. These are scored exactly.

The rows are dealt to blocks by a hash of the id, and each block has a forest of its own; the queries, a stated set, visit
every block in groups of bounded size. Within a block, vectors of like length have a forest of their own, as short ones
hash alike whatever their direction; the longest come first, and a query leaves out those too short to reach its k best.
So a task holds one block and one group of queries, whatever the table's size, and
each block hands on no more than the k best of a query.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
QUERY_ROWS = 8192
TREES, BITS = 48, 20
#: Different candidates of a query, as a share of the rows of a forest.
SHARE = 0.6
#: Shortest vector of a forest, as a share of its longest, and the least rows of a forest, however their lengths differ.
SPREAD, LEAST_ROWS = 0.8, 512
#: Queries that have their candidates marked at a time.
MARKED = 512


@lru_cache(maxsize=128)
def _axes(tree: int, width: int, bits: int) -> np.ndarray:
    """Random directions of a tree, at right angles as far as there are dimensions."""
    rng = np.random.default_rng(tree)
    parts = [np.linalg.qr(rng.standard_normal((width, width)))[0] for _ in range(-(-bits // width))]
    return np.hstack(parts)[:, :bits]


class Forest:
    """Sorted hash strings of a block's vectors, one array per tree.

    For the largest inner product, vectors get one more component that makes them equally long, and queries a zero there.
    """

    def __init__(self, vectors: np.ndarray, trees: int, bits: int):
        self.trees, self.bits = trees, bits
        squares = (vectors**2).sum(axis=1)
        self.longest = float(squares.max(initial=0.0)) or 1.0
        tall = np.hstack([vectors, np.sqrt(np.maximum(self.longest - squares, 0))[:, None]])
        self.order, self.strings = [], []
        for tree in range(trees):
            hashes = self._hash(tall, tree)
            order = np.argsort(hashes, kind="stable")
            self.order.append(order)
            self.strings.append(hashes[order])

    def _hash(self, tall: np.ndarray, tree: int) -> np.ndarray:
        signs = tall @ _axes(tree, tall.shape[1], self.bits) > 0
        return signs.astype(np.int64) @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def ranges(self, queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) places in each tree's array per query, at the longest prefix length that gives enough in all."""
        return self._climb(queries, wanted)[:2]

    def _climb(self, queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """The ranges, the number of bits dropped per query, and the queries' hashes in each tree."""
        tall = np.hstack([queries, np.zeros((len(queries), 1))])
        hashes = [self._hash(tall, tree) for tree in range(self.trees)]
        bits = np.full(len(queries), self.bits)
        first = np.zeros((self.trees, len(queries)), np.int64)
        last = np.full((self.trees, len(queries)), len(self.order[0]), np.int64)
        climbing = np.ones(len(queries), bool)
        for dropped in range(self.bits):
            if not climbing.any():
                break
            low, high = np.empty((2, self.trees, int(climbing.sum())), np.int64)
            for tree, (strings, values) in enumerate(zip(self.strings, hashes)):
                prefix = values[climbing] >> dropped
                low[tree] = np.searchsorted(strings, prefix << dropped)
                high[tree] = np.searchsorted(strings, (prefix + 1) << dropped)
            enough = (high - low).sum(axis=0) >= wanted
            done = np.flatnonzero(climbing)[enough]
            first[:, done], last[:, done] = low[:, enough], high[:, enough]
            bits[done] = dropped
            climbing[done] = False
        return first, last, bits, hashes

    def candidates(self, queries: np.ndarray, wanted: int) -> np.ndarray:
        """Per query a mark for each row in the ranges of the longest prefix length that gives enough different rows."""
        found = np.zeros((len(queries), len(self.order[0])), bool)
        first, last, dropped, hashes = self._climb(queries, wanted)
        climbing = np.arange(len(queries))
        while len(climbing):
            for i in climbing:
                if dropped[i] >= self.bits:
                    found[i] = True
                    continue
                for order, low, high in zip(self.order, first[:, i].tolist(), last[:, i].tolist()):
                    found[i, order[low:high]] = True
            climbing = climbing[(found[climbing].sum(axis=1) < wanted) & (dropped[climbing] < self.bits)]
            dropped[climbing] += 1
            for tree, (strings, values) in enumerate(zip(self.strings, hashes)):
                prefix = values[climbing] >> dropped[climbing]
                first[tree, climbing] = np.searchsorted(strings, prefix << dropped[climbing])
                last[tree, climbing] = np.searchsorted(strings, (prefix + 1) << dropped[climbing])
        return found


def alike(lengths: np.ndarray) -> list[np.ndarray]:
    """Rows of like length, the longest first."""
    order = np.argsort(-lengths, kind="stable")
    falling, out, at = -lengths[order], [], 0
    while at < len(order):
        end = max(at + LEAST_ROWS, int(np.searchsorted(falling, SPREAD * falling[at], side="right")))
        out.append(order[at:end])
        at = end
    return out


def _nearest(data: pa.Table, asked: pa.Table, k: int, trees: int, bits: int, share: float) -> pa.Table:
    """The k best rows of one block for each query."""

    def parts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        vectors = table.column("vec").combine_chunks()
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        return table.column("id").to_numpy(), flat.reshape(len(vectors), -1).astype(np.float64)

    out_query, out_id, out_score = [], [], []
    if len(data) and len(asked):
        ids, vectors = parts(data)
        query_ids, queries = parts(asked)
        lengths, reach = np.linalg.norm(vectors, axis=1), np.linalg.norm(queries, axis=1)
        forests = [(rows, Forest(vectors[rows], trees, bits)) for rows in alike(lengths)]
        for at in range(0, len(queries), MARKED):
            asking = np.arange(at, min(at + MARKED, len(queries)))
            best = {i: (np.empty(0, np.int64), np.empty(0)) for i in asking.tolist()}
            least = np.full(len(queries), -np.inf)
            for members, forest in forests:
                # Rounding must not leave out a row that ties.
                going = asking[least[asking] <= lengths[members[0]] * reach[asking] * (1 + 1e-9)]
                # So many that one tree alone would have k and the query itself, or else every row.
                marks = forest.candidates(queries[going], max((k + 1) * trees, int(share * len(members))))
                for i, found in zip(going.tolist(), marks):
                    rows = members[found]
                    rows = rows[ids[rows] != query_ids[i]]
                    scores = np.einsum("ij,j->i", vectors[rows], queries[i])
                    rows, scores = np.concatenate([best[i][0], rows]), np.concatenate([best[i][1], scores])
                    if len(rows) > k:
                        good = scores >= np.partition(scores, len(rows) - k)[len(rows) - k]
                        rows, scores = rows[good], scores[good]
                    top = np.lexsort((ids[rows], -scores))[:k]
                    best[i] = rows[top], scores[top]
                    if len(top) == k:
                        least[i] = scores[top[-1]]
            for i, (rows, scores) in best.items():
                out_query.append(np.full(len(rows), query_ids[i]))
                out_id.append(ids[rows])
                out_score.append(scores)
    return pa.table({
        "query_id": np.concatenate(out_query) if out_query else np.empty(0, np.int64),
        "vec_id": np.concatenate(out_id) if out_id else np.empty(0, np.int64),
        "score": np.concatenate(out_score) if out_score else np.empty(0, np.float64),
    })


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
    trees: int = TREES, bits: int = BITS, share: float = SHARE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank (from 1), vec_id, score.

    Near is the largest inner product of the original vectors in double precision; ties go to the smaller id. A query does
    not find its own id. Rows without an id, and vectors that are null, empty, zero, or hold a null or non-finite
    component take no part; only vectors of one length are compared. Rows that repeat an id count once, with the best
    score. A block that has no more rows than asked for is searched in full, so few candidates are all returned. An empty
    table gives no rows; other columns are not read.
    """
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.where(usable(vec) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), vec.alias("vec"), F.size(vec).alias("width"), is_query.alias("asks")
    )
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asked")).first()
    blocks, groups = max(1, -(-total.rows // block_rows)), max(1, -(-total.asked // query_rows))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    data = rows.select("id", "vec", "width", own.alias("block"), numbers(groups).alias("group"))
    asked = rows.where("asks").select("id", "vec", "width", numbers(blocks).alias("block"), group.alias("group"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _nearest(left, right, k, trees, bits, share)

    keys = ["width", "block", "group"]
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "query_id bigint, vec_id bigint, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.selectExpr(
        "query_id", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank", "vec_id", "score"
    )
    return ranked.where(F.col("rank") <= k)
