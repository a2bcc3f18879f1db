import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.plans import versions as V
from tests.conftest import rows_of

SCHEMA = "id bigint, v string"


def df(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def day(n):
    return dt.datetime(2024, 1, n)


def four_commits(spark, path):
    V.commit(df(spark, (1, "a"), (2, "b"), (3, None)), path, "overwrite", day(1))
    V.commit(df(spark, (4, "d")), path, "append", day(2))
    V.commit(df(spark, (1, "a"), (2, "B"), (3, "c"), (5, "e")), path, "overwrite", day(3))
    V.commit(df(spark, (6, "f")), path, "append", day(4))
    return path


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """For tests that only read."""
    return four_commits(spark, str(tmp_path_factory.mktemp("versioned")))


@pytest.fixture
def own_root(spark, folder):
    return four_commits(spark, folder("versioned"))


def test_every_version_can_be_read(spark, root):
    ids = [[r[0] for r in rows_of(V.as_of_version(spark, root, n), "id")] for n in range(4)]
    assert ids == [[1, 2, 3], [1, 2, 3, 4], [1, 2, 3, 5], [1, 2, 3, 5, 6]]
    assert V.as_of_version(spark, root).count() == 5


def test_reading_by_time(spark, root):
    assert V.as_of_time(spark, root, day(2)).count() == 4
    assert V.as_of_time(spark, root, dt.datetime(2024, 1, 1, 12)).count() == 3
    with pytest.raises(LookupError):
        V.as_of_time(spark, root, dt.datetime(2023, 1, 1))
    with pytest.raises(LookupError):
        V.as_of_version(spark, root, 9)


def test_history(spark, root):
    assert rows_of(V.history(spark, root), "version", "operation", "row_count", "committed_at") == [
        (0, "overwrite", 3, day(1)), (1, "append", 1, day(2)), (2, "overwrite", 4, day(3)), (3, "append", 1, day(4)),
    ]


def test_an_append_writes_its_own_rows_only(spark, root):
    assert spark.read.parquet(f"{root}/data/__version=3").count() == 1


def test_change_feed(spark, root):
    feed = V.change_feed(spark, root, ["id"], 1, 2)
    assert rows_of(feed, "_commit_version", "_change_type", "id", "v") == [
        (1, "insert", 4, "d"), (2, "delete", 4, "d"), (2, "insert", 5, "e"), (2, "update_postimage", 2, "B"),
        (2, "update_postimage", 3, "c"), (2, "update_preimage", 2, "b"), (2, "update_preimage", 3, None),
    ]
    assert V.change_feed(spark, root, ["id"]).where("_commit_version = 0").count() == 3


def test_feed_applied_to_a_version_gives_the_next(spark, root):
    state = V.as_of_version(spark, root, 0)
    for n in (1, 2, 3):
        state = V.apply_changes(state, V.change_feed(spark, root, ["id"], n, n), ["id"])
        assert rows_of(state) == rows_of(V.as_of_version(spark, root, n))


def test_unfinished_commit_is_not_seen(spark, own_root):
    df(spark, (9, "half")).write.parquet(f"{own_root}/data/__version=4")
    assert V.as_of_version(spark, own_root).count() == 5
    V.commit(df(spark, (7, "g")), own_root, "append", day(5))
    assert rows_of(V.as_of_version(spark, own_root), "id")[-1] == (7,)


def test_schema_is_enforced(spark, root):
    before = V.history(spark, root).count()
    with pytest.raises(ValueError, match="v: missing"):
        V.commit(df(spark, (8,), schema="id bigint"), root)
    with pytest.raises(ValueError, match="id: type"):
        V.commit(df(spark, ("8", "x"), schema="id string, v string"), root, merge_schema=True)
    assert V.history(spark, root).count() == before


def test_schema_widens_on_request(spark, own_root):
    wide = df(spark, (8, 1.5), schema="id bigint, price double")
    V.commit(wide, own_root, "append", merge_schema=True)
    out = V.as_of_version(spark, own_root)
    assert out.columns == ["id", "v", "price"]
    assert rows_of(out.where("id in (6, 8)")) == [(6, "f", None), (8, None, 1.5)]
    assert V.as_of_version(spark, own_root, 3).columns == ["id", "v"]


def test_batch_is_committed_once(spark, folder):
    path = folder()
    write = V.commit_batch(path, "a")
    for batch_id in (0, 1, 1, 0):
        write(df(spark, (batch_id, "x")), batch_id)
    assert rows_of(V.as_of_version(spark, path), "id") == [(0,), (1,)]
    assert rows_of(V.history(spark, path), "version", "batch_id") == [(0, 0), (1, 1)]


def test_empty_commit(spark, folder):
    path = folder()
    V.commit(df(spark, schema=SCHEMA), path, "overwrite")
    assert V.as_of_version(spark, path).count() == 0 and V.as_of_version(spark, path).columns == ["id", "v"]


def test_missing_table(spark, folder):
    with pytest.raises(LookupError):
        V.as_of_version(spark, folder())


def test_batches_of_two_writers_and_a_restart(spark, folder):
    path = folder()
    for writer, number, key in (("a", 0, 1), ("b", 0, 2), ("a", 1, 3), ("a", 0, 1), ("b", 0, 2), ("b again", 0, 4)):
        V.commit_batch(path, writer)(df(spark, (key, writer)), number)
    assert rows_of(V.as_of_version(spark, path), "id") == [(1,), (2,), (3,), (4,)]


def test_times_are_kept_to_the_microsecond_and_go_forward(spark, folder):
    path = folder()
    exact = dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    V.commit(df(spark, (1, "a")), path, "overwrite", exact)
    assert V.entry_of(spark, path).committed_at == exact
    with pytest.raises(LookupError):
        V.as_of_time(spark, path, exact - dt.timedelta(microseconds=1))
    with pytest.raises(ValueError, match="before"):
        V.commit(df(spark, (2, "b")), path, "append", day(1))
    assert V.as_of_time(spark, path, exact).count() == 1


def test_many_commits_of_a_stream(spark, folder):
    path = folder()
    write = V.commit_batch(path, "stream")
    for number in range(15):
        write(spark.range(number, number + 1).selectExpr("id", "'x' AS v").coalesce(1), number)
    assert V.entry_of(spark, path).version == 14
    assert sorted(r.id for r in V.as_of_version(spark, path).collect()) == list(range(15))
    assert sorted(r.id for r in V.as_of_version(spark, path, 3).collect()) == [0, 1, 2, 3]
    feed = V.change_feed(spark, path, ["id"], 4, 9)
    assert rows_of(feed, V.CHANGE_VERSION, "id", V.CHANGE_TYPE) == rows_of(spark.range(4, 10).selectExpr("id", "id AS n", "'insert' AS t"))


def test_a_version_reads_its_own_partitions(spark, root):
    plan = V.as_of_version(spark, root, 3)._jdf.queryExecution().executedPlan().toString()
    assert "__version" in plan.split("PartitionFilters")[1]
    assert {f.split("__version=")[1].split("/")[0] for f in V.as_of_version(spark, root, 3).inputFiles()} >= {"2", "3"}


def test_an_overwrite_may_change_the_columns(spark, folder):
    path = folder()
    V.commit(df(spark, (1, "a")), path, "overwrite")
    V.commit(df(spark, (2, 2.5), schema="id bigint, v double"), path, "overwrite")
    V.commit(df(spark, (3, 3.5), schema="id bigint, v double"), path, "append")
    assert rows_of(V.as_of_version(spark, path)) == [(2, 2.5), (3, 3.5)] and rows_of(V.as_of_version(spark, path, 0)) == [(1, "a")]
    assert rows_of(V.change_feed(spark, path, ["id"], 2), "id", "v") == [(3, 3.5)]


def test_compare_with_composite_and_null_keys(spark):
    schema = "a int, b string, v int"
    old = df(spark, (1, None, 1), (1, "x", 2), schema=schema)
    new = df(spark, (1, None, 5), (2, "x", 2), schema=schema)
    out = V.compare(old, new, ["a", "b"]).groupBy(V.CHANGE_TYPE).agg(F.count(F.lit(1)))
    assert dict(rows_of(out)) == {"update_preimage": 1, "update_postimage": 1, "insert": 1, "delete": 1}


def test_staged_rows_are_not_seen(spark, folder):
    path = folder()
    V.commit(df(spark, (1, "a")), path, "overwrite")
    entry = V.write_next(df(spark, (2, "b")), path, "overwrite")
    assert rows_of(V.as_of_version(spark, path), "id") == [(1,)]
    assert rows_of(V.partitions(spark, path, entry), "id") == [(2,)]
    assert V.record(spark, path, entry) == 1 and rows_of(V.as_of_version(spark, path), "id") == [(2,)]
