import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.llm.packing import PER_SEQUENCE, SIZES, best_fit, cheapest, opened, pack, pack_documents, with_bins, word_count
from tests.llm.data import TEXTS, documents
from tests.llm.test_quality import counted

SMALL = {8: 9.0, 16: 17.0, 32: 36.0}


def plain_best_fit(lengths, sizes, largest):
    bins = []
    for length in lengths:
        fitting = [(size - used, i) for i, (size, used) in enumerate(bins) if size - used >= length]
        if fitting:
            room = min(r for r, _ in fitting)
            i = max(i for r, i in fitting if r == room)
            bins[i][1] += length
        else:
            bins.append([opened(sizes, length, largest), length])
    return sorted(used for _, used in bins)


def test_same_bins_as_a_plain_search():
    for seed in range(30):
        rnd = random.Random(seed)
        lengths = sorted((rnd.randint(1, 32) for _ in range(80)), reverse=True)
        for largest in SMALL:
            places, contents = best_fit(lengths, SMALL, largest)
            filled = defaultdict(int)
            for length, place in zip(lengths, places):
                filled[place] += length
            assert sorted(filled.values()) == sorted(contents) and max(contents) <= 32
            assert sum(contents) == sum(lengths)
            plain = plain_best_fit(lengths, SMALL, largest)
            assert len(plain) == len(contents) and sum(plain) == sum(contents)


def test_joint_choice_is_the_cheapest_and_bins_are_cut_down():
    for seed in range(30):
        rnd = random.Random(seed)
        lengths = sorted((rnd.randint(1, 20) for _ in range(50)), reverse=True)
        places, final = pack(lengths, SMALL)
        cost = sum(SMALL[s] for s in final)
        for largest in SMALL:
            _, contents = best_fit(lengths, SMALL, largest)
            assert cost <= sum(SMALL[cheapest(SMALL, c)] for c in contents)
        used = defaultdict(int)
        for length, place in zip(lengths, places):
            used[place] += length
        assert all(cheapest(SMALL, n) == final[b] for b, n in used.items())


def costs_of(lengths, sizes):
    """Cost and final sizes of every trial."""
    out = {}
    for largest in sizes:
        _, contents = best_fit(lengths, sizes, largest)
        final = [cheapest(sizes, c) for c in contents]
        out[largest] = (sum(sizes[s] for s in final), sorted(final))
    return out


def test_trials_differ_and_bins_shrink_without_a_fixed_cost():
    lengths, sizes = [300] * 4999, {size: cost - PER_SEQUENCE for size, cost in SIZES.items()}
    trials = costs_of(lengths, sizes)
    assert len({cost for cost, _ in trials.values()}) == len(sizes)
    places, final = pack(lengths, sizes)
    assert sum(sizes[s] for s in final) == min(cost for cost, _ in trials.values()) == trials[1024][0]
    assert sorted(final) == [512] + [1024] * 1666
    assert all(trials[largest][1].count(512) == 1 for largest in (1024, 2048))


def test_production_sizes_choose_between_trials():
    # 13 texts of 300 words fill the longest sequence best, the six left over are cut down to 2048; texts of 1000 go by twos.
    trials = costs_of([300] * 4998, SIZES)
    assert len({cost for cost, _ in trials.values()}) == len(SIZES)
    _, final = pack([300] * 4998, SIZES)
    assert sorted(final) == trials[4096][1] == [2048] + [4096] * 384
    _, final = pack([1000] * 4001, SIZES)
    assert sorted(final) == [1024] + [2048] * 2000


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_given_tables_cost_less_than_in_the_smallest_size_that_fits(sf):
    """The trial of the smallest size opens for each piece the smallest size that holds it."""
    texts = pd.read_parquet(f"/root/testdata/{sf}/documents.parquet", columns=["text"])["text"]
    words = [counted(t)[0] for t in texts]
    longest = max(SIZES)
    lengths = sorted([longest] * sum(n // longest for n in words) + [n % longest for n in words if n % longest], reverse=True)
    _, final = pack(lengths, SIZES)
    cost, smallest = costs_of(lengths, SIZES)[min(SIZES)]
    assert sum(SIZES[s] for s in final) < 0.95 * cost and sorted(final) != smallest


def check(rows, lengths, sizes):
    """Every unit of every document once, no bin too full, no place used twice, bins as small as they can be."""
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length))
        bins[r.bin_id].append((r.bin_offset, r.length, r.bin_size))
    for doc, n in lengths.items():
        copies = len([p for p in pieces.get(doc, []) if p[0] == 0])
        assert sum(length for _, length in pieces.get(doc, [])) == n * copies
    for held in bins.values():
        at = 0
        for offset, length, size in sorted(held):
            assert offset == at and len({s for _, _, s in held}) == 1
            at += length
        assert cheapest(sizes, at) == held[0][2]
    return bins


def test_awkward_documents(spark):
    docs = documents(spark, extra="'x' AS bin_id")
    rows = pack_documents(docs, word_count(F.col("text")), sizes=SMALL, group_pieces=4).collect()
    lengths = {i: counted(t)[0] for i, t in TEXTS if i is not None}
    check([r for r in rows if r.doc_id is not None], {}, SMALL)
    assert {r.doc_id for r in rows if r.doc_id is not None} == {i for i, n in lengths.items() if n}
    for doc, n in lengths.items():
        copies = sum(i == doc for i, _ in TEXTS)
        assert sum(r.length for r in rows if r.doc_id == doc) == n * copies
    assert pack_documents(documents(spark, []), word_count(F.col("text"))).count() == 0
    joined = with_bins(docs, pack_documents(docs, word_count(F.col("text"))))
    assert joined.columns == ["doc_id", "text", "piece", "start", "length", "bin_id", "bin_size", "bin_offset"]


def test_corpus_is_packed_tightly(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack_documents(docs, word_count(F.col("text"))).collect()
    lengths = {r.doc_id: counted(r.text)[0] for r in docs.collect()}
    bins = check(rows, lengths, SIZES)
    assert sum(r.length for r in rows) == sum(lengths.values())
    assert sum(r.length for r in rows) > 0.97 * sum(held[0][2] for held in bins.values())
    again = pack_documents(docs.repartition(5), word_count(F.col("text"))).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
