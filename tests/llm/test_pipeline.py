import re

import pytest

import corpus_pipeline
from quern.llm.packing import SIZES
from tests.llm.data import documents, prose
from tests.llm.test_neardup import brute as brute_groups
from tests.llm.test_packing import check
from tests.llm.test_quality import base_failed, counted
from tests.llm.test_secrets import brute as brute_secrets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def cleaned(text):
    out, at = [], 0
    for start, _, end in brute_secrets(text):
        if start > at or not out:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_stages_one_by_one(spark, docs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "secret scans", "best-fit packing"]
    quality, groups, secrets, packing = (stage for _, stage in corpus_pipeline.STAGES)

    kept = quality(spark, docs, SF)
    assert kept.columns == COLUMNS
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    passing = {r.doc_id for r in docs.collect() if not base_failed(counted(r.text))}
    ids = {r.doc_id for r in kept.collect()}
    assert ids <= passing and {i for i in passing if labels.get(i) == 1} <= ids
    assert not {i for i in ids if labels.get(i) == 0}

    single = groups(spark, kept, SF)
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    want = brute_groups(texts, 5, 80)
    assert single.columns == COLUMNS and {r.doc_id for r in single.collect()} == {i for i in want if want[i] == i}

    safe = secrets(spark, single, SF)
    before = {r.doc_id: r.text for r in single.collect()}
    rows = safe.collect()
    assert safe.columns == COLUMNS and len(rows) == len(before)
    for r in rows:
        assert r.text == cleaned(before[r.doc_id]) and r.n_chars == len(r.text)
        assert not re.search(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}", r.text)

    packed = packing(spark, safe, SF)
    lengths = {r.doc_id: counted(r.text)[0] for r in rows}
    check(packed.collect(), lengths, SIZES)
    assert {r.doc_id for r in packed.collect()} == set(lengths)


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, docs.collect())) and rows


def test_awkward_documents(spark, tmp_path):
    rows = [(1, None), (2, ""), (None, prose(80, 1)), (3, prose(80, 2)), (3, prose(80, 2)), (4, prose(80, 2)),
            (5, prose(5000, 3)), (6, prose(60, 4) + " password=abcdefghijklmnop")]
    docs = documents(spark, rows).selectExpr("*", "cast(NULL AS string) lang", "cast(NULL AS string) source", "0L n_chars", "1 AS kept")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {None, 3, 5, 6}
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/empty/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/empty/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
