import re
from collections import Counter

import numpy as np
import pyarrow as pa

import quern.llm.sketches as sketches
from quern.llm.quality import COUNTS, FEATURES, fit_quality, judge_quality, statistics
from quern.llm.trees import fit_forest
from tests.llm.data import TEXTS, documents

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = list(zip(words, words[1:], words[2:]))
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    )


def base_failed(row):
    return row[0] < 50 or 100 * row[4] > 50 * row[0]


def test_counts_of_awkward_texts():
    texts = [t for _, t in TEXTS]
    counts, features = statistics(pa.array(texts))
    assert [tuple(c) for c in counts.tolist()] == [counted(t) for t in texts]
    assert features.shape == (len(texts), len(FEATURES)) and np.isfinite(features).all()


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    texts = [t for _, t in TEXTS if t]
    whole = statistics(pa.array(texts))[0].tolist()
    monkeypatch.setattr(sketches, "CHUNK", 64)
    assert statistics(pa.array(texts))[0].tolist() == whole


def test_sliced_column():
    texts = pa.array([t for _, t in TEXTS])
    assert statistics(texts.slice(4, 6))[0].tolist() == statistics(texts)[0][4:10].tolist()


def test_forest_keeps_directions_and_learns():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] - x[:, 1] + 0.3 * rng.standard_normal(2000)) > 0).astype(float)
    forest = fit_forest(x, y, [1, -1, 0])
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.8
    at = rng.random((50, 3))
    for feature, sign in ((0, 1), (1, -1)):
        steps = np.repeat(at[:, None], 40, axis=1)
        steps[:, :, feature] = np.linspace(-1, 2, 40)
        scores = forest.margin(steps.reshape(-1, 3)).reshape(50, 40)
        assert (sign * np.diff(scores, axis=1) >= -1e-9).all()


def test_forest_walks_as_a_plain_tree_does():
    rng = np.random.default_rng(1)
    x = rng.random((300, 4))
    forest = fit_forest(x, (x[:, 0] > 0.5).astype(float), [0, 0, 0, 0], rounds=5)

    def plain(row):
        total = forest.base
        for at in forest.roots:
            while forest.left[at] != at:
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        return total

    assert np.allclose(forest.margin(x), [plain(row) for row in x])


def test_without_labels_all_is_good(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    forest = fit_quality(documents(spark), labels)
    rows = judge_quality(documents(spark, extra="1 AS Kept"), forest).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, *(r[c] for c in COUNTS), r.base_failed, r.kept) for r in rows) == sorted(
        (i is None, i or 0, *counted(t), base_failed(counted(t)), not base_failed(counted(t))) for i, t in TEXTS
    )
    assert judge_quality(documents(spark, []), forest).count() == 0


def test_awkward_labels(spark):
    labels = spark.createDataFrame([(6, 1), (6, 0), (None, 1), (8, None), (13, 0), (0, 1), (99, 1)], "doc_id bigint, quality int")
    forest = fit_quality(documents(spark), labels)
    assert judge_quality(documents(spark), forest).count() == len(TEXTS)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    forest = fit_quality(docs, labels.where("doc_id % 2 = 0"))
    rows = judge_quality(docs, forest).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad) and bad
