import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import quern.llm.neardup as neardup
from quern.llm.components import components
from quern.llm.neardup import near_duplicates
from quern.llm.sketches import band_hashes, band_shape, shingle_sets, sketch_sets
from tests.llm.data import TEXTS, documents, prose

FOLD = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    """id -> (size of the set, smallest id reachable), by comparing all pairs."""
    sets = defaultdict(list)
    for i, text in rows:
        sets[i].append(shingles(text, size))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(
                100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b] if s and t
            ):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(text, share, seed):
    rnd = random.Random(seed)
    return " ".join(w if rnd.random() > share else f"new{seed}x{k}" for k, w in enumerate(text.split()))


def family(n, share, start, base):
    return [(start + k, edited(base, share * (k % 10) / 10, start + k)) for k in range(n)]


def result(df):
    return {r.doc_id: r.component_id for r in df.collect()}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_awkward_documents(spark, size, percent):
    df = near_duplicates(documents(spark, extra="'x' AS component_id"), size=size, percent=percent)
    rows = df.collect()
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"] and len(rows) == len(TEXTS)
    named = [(i, t) for i, t in TEXTS if i is not None]
    want = brute(named, size, percent)
    for r in rows:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
        else:
            assert r.component_id is None and r.kept
    sizes = sorted((i, len(shingles(t, size))) for i, t in named)
    assert sorted((r.doc_id, r.n_shingles) for r in rows if r.doc_id is not None) == sizes


def test_row_without_id_follows_its_text(spark):
    rows = near_duplicates(documents(spark, [(None, prose(50)), (4, prose(50)), (9, prose(50))])).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in rows) == [(-1, 4, False), (4, 4, True), (9, 4, False)]


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert near_duplicates(documents(spark, [(1, "alone"), (2, None)])).count() == 2


def test_families_chains_and_shared_passages(spark):
    rows = []
    for f in range(6):
        rows += family(12, 0.08, 100 * f, prose(150, seed=50 + f))
    words = prose(200, seed=70).split()
    rows += [(1000 + k, " ".join(words[4 * k :] + [f"tail{j}" for j in range(4 * k)])) for k in range(12)]
    passage = prose(60, seed=71)
    rows += [(2000 + k, passage + " " + prose(40 + 10 * (k % 7), seed=200 + k)) for k in range(25)]
    random.Random(0).shuffle(rows)
    assert result(near_duplicates(documents(spark, rows), size=3, percent=85)) == brute(rows, 3, 85)


def test_large_group_of_near_copies(spark, monkeypatch):
    """Buckets far above SMALL: pivots and the last pass give the same as all pairs."""
    monkeypatch.setattr(neardup, "SMALL", 3)
    base = prose(120, seed=90, vocabulary=4000)
    rows = [(k, edited(base, 0.02 * (k % 5), k)) for k in range(90)]
    rows += [(500 + k, base) for k in range(40)]
    rows += [(700 + k, edited(edited(base, 0.05, 1), 0.01 * (k % 4), 700 + k)) for k in range(40)]
    assert result(near_duplicates(documents(spark, rows), size=3, percent=85)) == brute(rows, 3, 85)


def test_sketches_estimate_similarity_and_fill_every_coordinate():
    rng = np.random.default_rng(0)
    for n in (1, 3, 40, 2000):
        shared = []
        for _ in range(60):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            b = a.copy()
            b[: n // 4] = rng.integers(0, 1 << 63, n // 4).astype(np.uint64)
            s, t = sketch_sets([a, b], 125)
            assert (s != 0).all()
            shared.append((s == t).mean())
        want = (n - n // 4) / (n + n // 4)
        assert abs(np.mean(shared) - want) < 0.02
    one, many = sketch_sets([a], 125), sketch_sets([b, a], 125)
    assert (one[0] == many[1]).all()


def test_bands_miss_less_than_asked():
    for threshold in (0.8, 0.85, 0.95):
        bands, rows = band_shape(threshold)
        assert bands * rows <= 128 and (1 - threshold**rows) ** bands <= 1e-6
    assert band_hashes(sketch_sets([np.arange(9, dtype=np.uint64)], 125), 25, 5).shape == (1, 25)


def test_shingle_sets_of_awkward_texts():
    texts = [t for _, t in TEXTS]
    got = [len(s) for _, sets in shingle_sets(pa.array(texts), 3) for s in sets]
    assert got == [len(shingles(t, 3)) for t in texts]


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (50, 51), (51, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    want = {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 140)} | {51: 50}
    assert got == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_one_of_each_judges_rows_by_their_own_text(spark):
    a, b, c, d, e = (prose(90, seed) for seed in (41, 42, 43, 44, 45))
    rows = [
        (1, a), (2, a), (2, b), (2, e),  # a copy of a smaller id, and two texts of its own under one id
        (None, a), (None, a), (None, c), (None, c), (None, c + " more"),  # copies without an id
        (3, d), (3, d), (3, d + " more"), (4, None), (4, None), (None, None), (5, ""), (6, " \n"),
    ]
    df = documents(spark, rows, "'x' AS component_id").withColumn("digest", F.lit(1))
    out = neardup.one_of_each(df, size=5, percent=80)
    assert out.columns == df.columns
    got = sorted((str(r.doc_id), str(r.text)) for r in out.collect())
    first_c, first_d = (min((t, t + " more"), key=lambda x: hashlib.md5(x.encode()).hexdigest()) for t in (c, d))
    want = [(1, a), (2, b), (2, e), (None, first_c), (3, first_d), (4, None), (4, None), (None, None), (5, ""), (6, " \n")]
    assert got == sorted((str(i), str(t)) for i, t in want)
    assert neardup.one_of_each(df.limit(0)).count() == 0
