import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm.bond import Block, mine_negatives, nearest_rows, number_type, rows_in_windows, vertical_scan, window_below

LONG = (-(2**63), 2**63 - 1)


def brute(rows, every=1, scale=256, positives=5, negatives=3, low=50, high=95):
    """All rows against all, in whole numbers of any size."""
    best = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        row = (label, [min(max(math.floor(scale * x), LONG[0]), LONG[1]) for x in vec])
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (label, q) in best.items():
        if a % every:
            continue
        scored = [(sum(x * y for x, y in zip(q, v)), i, kind) for i, (kind, v) in best.items() if i != a and len(v) == len(q)]
        order = sorted(scored, key=lambda s: (-s[0], s[1]))
        for score, p, _ in [s for s in order if s[2] == label][:positives]:
            inside = [s for s in order if s[2] != label and low * score <= 100 * s[0] <= high * score][:negatives]
            out += [(a, p, r, n, score, found) for r, (found, n, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, every=1, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS width")
    got = mine_negatives(df, F.col("vec_id") % every == 0, F.col("label"), **options)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def near_rows(n, width=12, seed=1, labels=4):
    rnd = random.Random(seed)
    centre = [rnd.gauss(0, 1) for _ in range(width)]
    return [(i, rnd.choice([0] * 3 + list(range(labels))), [c * rnd.random() + rnd.gauss(0, 0.4) for c in centre]) for i in range(n)]


def test_as_all_against_all(spark):
    rows = near_rows(400)
    want = brute(rows, 3)
    assert len(want) > 500
    assert mined(spark, rows, 3) == want
    # Many blocks and groups of anchors give the same.
    assert mined(spark, rows, 3, block_values=300, anchor_values=200) == want


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = near_rows(40, 3) + [
        (None, 1, [1.0, 1.0, 1.0]), (50, None, [1.0, 1.0, 1.0]), (51, 1, None), (52, 1, [nan, 1.0, 1.0]), (53, 1, [inf, 1.0, 1.0]),
        (54, 1, [1.0, None, 1.0]), (55, 1, []), (56, 2, []), (57, 1, []), (58, 1, [2.0, 2.0]), (59, 2, [1.9, 1.0]), (60, 1, [2.0, 2.0]),
        (61, 3, [0.0, 0.0, 0.0]), (62, 3, [0.0, 0.0, 0.0]), (63, 2, [0.0, 0.0, 0.0]), (64, 5, [1.0, 0.0, 0.0]), (64, 1, [9.0, 9.0, 9.0]),
        (64, 1, [2.0, 2.0, 2.0]), (64, 1, [2.0, 2.0, 2.0]), (65, -7, [1.0, 1.0, 1.0]),
    ] + [(100 + i, 1 + i % 2, [1.0, 1.0, 0.5]) for i in range(60)]  # ties
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0])]) == []


def test_one_label_has_nearly_all_rows(spark):
    rows = [(i, 9 if i % 50 else 1, v) for i, _, v in near_rows(300)]
    assert mined(spark, rows, 10, block_values=500) == brute(rows, 10)


@pytest.mark.parametrize("size", [1e3, 1e5, 1e14])
def test_numbers_of_any_size_are_exact(size):
    rows = [(i, label, [x * size for x in v]) for i, label, v in near_rows(60, 4)]
    ids, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    vectors = np.array([[math.floor(256 * x) for x in r[2]] for r in rows], dtype=np.int64)
    kind = number_type(vectors, vectors)
    assert kind is {1e3: np.float64, 1e5: np.int64, 1e14: object}[size]
    block, out = Block(ids, labels, vectors.astype(kind)), []
    for i, label, _ in rows:
        anchor = vectors[i].astype(kind)
        for p, score in zip(*nearest_rows(block, anchor, label, i, 5)):
            ((found, scores),) = rows_in_windows(block, anchor, label, i, [window_below(int(score), 50, 95)], 3)
            out += [(i, int(p), r, int(n), int(score), int(s)) for r, (n, s) in enumerate(zip(found, scores), 1)]
    assert sorted(out) == brute(rows)


def test_scores_beyond_a_long_end_there(spark):
    rows = [(i, i % 2, [x * 1e15 for x in v]) for i, _, v in near_rows(12, 4)]
    assert all(LONG[0] <= x <= LONG[1] for row in mined(spark, rows) for x in row)


def test_dimensions_go_by_magnitude_and_candidates_shrink():
    rnd = np.random.default_rng(1)
    vectors = rnd.normal(size=(2000, 32)).round(2) * 100
    vectors[:, :4] *= 20
    anchor, left = vectors[7], []
    extent = vectors.min(axis=0), vectors.max(axis=0)

    def keep(partial, low, high):
        left.append(len(partial))
        bound = np.partition(partial, len(partial) - 5)[len(partial) - 5] + low
        return partial + high >= bound

    rows, scores = vertical_scan(np.ascontiguousarray(vectors.T), extent, anchor, np.arange(2000), keep)
    assert left[0] == 2000 and left[-1] < 1000 and len(left) == 4
    assert np.allclose(scores, vectors[rows] @ anchor)
    assert set(np.argsort(-(vectors @ anchor))[:5]) <= set(rows.tolist())


def test_windows_are_whole_numbers():
    for score in (-7, -1, 0, 1, 2, 39, 41, 10**30 + 1):
        low, high = window_below(score, 50, 95)
        inside = [n for n in range(low - 3, low + 4) if 50 * score <= 100 * n <= 95 * score]
        assert inside == [n for n in range(low - 3, low + 4) if low <= n <= high]
        assert 100 * high <= 95 * score < 100 * (high + 1)
