import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm.ann import Forest, search

SF = "/root/testdata/sf0.01"


def brute(rows, k, every=20):
    """query -> [(id, score)], best first, by scoring every pair of usable vectors of one length."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, float))
    out = {}
    for q in (i for i in good if i % every == 0):
        scores = {}
        for v in good[q]:
            for i, others in good.items():
                for o in others:
                    if i != q and len(o) == len(v):
                        scores[i] = max(scores.get(i, -np.inf), float(v @ o))
        best = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
        if best:
            out[q] = best
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")


def test_awkward_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)], 1) for i in range(12)]
    rows += [
        (20, None, 1), (21, [], 1), (22, [0.0] * 8, 1), (23, [None] + [1.0] * 7, 1), (24, [float("nan")] * 8, 1),
        (25, [float("inf")] * 8, 1), (None, [1.0] * 8, 1), (40, [1.0, 2.0], 1), (41, [1.0, 3.0], 1),
    ]
    rows += [(30 + k, rows[3][1], 1) for k in range(3)] + [rows[3], (60, rows[0][1], 1)]
    want = brute([r[:2] for r in rows], 20)
    same(found(search(frame(spark, rows), F.col("vec_id") % 20 == 0)), want)
    assert search(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0, 2.0], 0) for i in range(50)]
    got = found(search(frame(spark, rows), F.col("vec_id") == 7, k=5))
    assert got == {7: [(i, 5.0) for i in (0, 1, 2, 3, 4)]}


def test_many_blocks_and_groups_of_queries(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(6)], 1) for i in range(300)]
    df = search(frame(spark, rows), F.col("vec_id") % 20 == 0, share=100.0, block_rows=70, query_rows=4)
    same(found(df), brute([r[:2] for r in rows], 20))


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall(spark, scale):
    df = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 20)
    got = found(search(df, F.col("vec_id") % 20 == 0))
    assert got.keys() == want.keys()
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])
    assert recall >= 0.9
    for q in want:
        exact = dict(want[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in got[q] if i in exact)


def test_ranges_hold_the_longest_common_prefixes():
    rng = np.random.default_rng(2)
    vectors, queries = rng.standard_normal((400, 10)), rng.standard_normal((30, 10))
    forest = Forest(vectors, trees=5, bits=12)
    first, last = forest.ranges(queries, wanted=40)
    tall = np.hstack([queries, np.zeros((30, 1))])
    for q in range(30):
        strings = [int(forest._hash(tall, t)[q]) for t in range(5)]
        for length in range(12, -1, -1):
            held = [np.flatnonzero(forest.strings[t] >> (12 - length) == strings[t] >> (12 - length)) for t in range(5)]
            if sum(map(len, held)) >= 40 or length == 0:
                break
        assert [last[t, q] - first[t, q] for t in range(5)] == [len(h) for h in held]


@pytest.mark.parametrize("spread", [0.0, 0.35, 0.5])
def test_recall_whatever_the_lengths(spark, spread):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((2000, 64))
    vectors *= np.exp(spread * rng.standard_normal((2000, 1))) / np.linalg.norm(vectors, axis=1)[:, None]
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(vectors)]
    want = brute([r[:2] for r in rows], 20)
    got = found(search(frame(spark, rows), F.col("vec_id") % 20 == 0))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.95


def test_candidates_are_different_rows():
    rng = np.random.default_rng(4)
    forest = Forest(rng.standard_normal((600, 16)), trees=6, bits=12)
    queries = rng.standard_normal((40, 16))
    for wanted in (1, 100, 400, 600, 1000):
        assert (forest.candidates(queries, wanted).sum(axis=1) >= min(wanted, 600)).all()
