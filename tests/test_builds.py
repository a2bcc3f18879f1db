import datetime as dt
import os
import re
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from quern.operators.quality import is_positive, not_null
from quern.plans import builds as B
from quern.plans import versions as V
from quern.sources.writers import write_partitioned
from tests.conftest import rows_of

SCHEMA = "id bigint, v string, seq int"


def df(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def target(spark):
    return df(spark, (1, "a", 0), (2, "b", 0), (3, "c", 0), (None, "n", 0))


def test_merge_updates_inserts_and_keeps(spark):
    batch = df(spark, (2, "B", 1), (4, "d", 1))
    out = B.merge(target(spark), batch, ["id"])
    assert rows_of(out, "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d"), (None, "n")]


def test_merge_of_repeated_keys_takes_the_newest(spark):
    batch = df(spark, (2, "old", 1), (2, "new", 3), (2, "mid", 2))
    assert rows_of(B.merge(target(spark), batch, ["id"], ["seq"]).where("id = 2"), "v") == [("new",)]


def test_merge_twice_is_merge_once(spark):
    batch = df(spark, (2, "B", 1), (2, "C", 2), (4, "d", 1))
    once = B.merge(target(spark), batch, ["id"], ["seq"])
    assert rows_of(B.merge(once, batch, ["id"], ["seq"])) == rows_of(once)


def test_null_keys_never_match(spark):
    out = B.merge(target(spark), df(spark, (None, "x", 1), (None, "y", 2)), ["id"], ["seq"])
    assert rows_of(out.where("id is null"), "v") == [("n",), ("x",), ("y",)]


def test_composite_key(spark):
    schema = "a int, b int, v string"
    old = df(spark, (1, 1, "x"), (1, 2, "y"), schema=schema)
    out = B.merge(old, df(spark, (1, 2, "Y"), (2, 2, "z"), schema=schema), ["a", "b"])
    assert rows_of(out, "a", "b", "v") == [(1, 1, "x"), (1, 2, "Y"), (2, 2, "z")]


def test_delete_insert_keeps_repeated_keys(spark):
    out = B.delete_insert(target(spark), df(spark, (2, "x", 1), (2, "y", 1)), ["id"])
    assert rows_of(out, "id", "v") == [(1, "a"), (2, "x"), (2, "y"), (3, "c"), (None, "n")]


def test_predicate_leaves_rows_outside_alone(spark):
    out = B.merge(target(spark), df(spark, (1, "A", 1), (3, "C", 1)), ["id"], target_predicate="id >= 2")
    assert rows_of(out, "id", "v") == [(1, "A"), (1, "a"), (2, "b"), (3, "C"), (None, "n")]


def test_watermark_is_strict(spark):
    old = df(spark, (1, "a", 5))
    fresh = B.new_rows(df(spark, (2, "b", 5), (3, "c", 6)), old, "seq")
    assert rows_of(fresh, "id") == [(3,)]
    assert B.new_rows(old, old.where("false"), "seq").count() == 1


def test_incremental_runs(spark, folder):
    root = folder()
    assert B.build_incremental(root, df(spark, (1, "a", 1), (2, "b", 2)), "seq").count() == 2
    assert B.build_incremental(root, df(spark, (2, "b", 2), (3, "c", 3)), "seq").count() == 3
    out = B.build_incremental(root, df(spark, (1, "A", 9)), None, ["id"], "merge")
    assert rows_of(out, "id", "v") == [(1, "A"), (2, "b"), (3, "c")]
    refreshed = B.build_incremental(root, df(spark, (7, "z", 1)).withColumn("extra", F.lit(1)), full_refresh=True)
    assert rows_of(refreshed) == [(7, "z", 1, 1)]
    assert [r.strategy for r in B.loads(spark, root).orderBy("load").collect()] == ["full", "append", "merge", "full"]


PARTS = "id bigint, v string, p int"


def written(out):
    """{folder: times of its files} of a frame read from files."""
    found = {}
    for f in out.inputFiles():
        file = unquote(urlparse(f).path)
        found.setdefault(os.path.dirname(file), set()).add((file, os.stat(file).st_mtime_ns))
    return found


def untouched(before, after):
    return {os.path.basename(folder) for folder, files in before.items() if after.get(folder) == files}


def test_merge_inside_a_window_of_partitions(spark, folder):
    path = folder()
    rows = [(i, f"v{i}", p) for p in (1, 2, 3) for i in range(p * 10, p * 10 + 3)]
    first = write_partitioned(df(spark, *rows, schema=PARTS), path, ["p"])
    before = written(first)
    batch = df(spark, (30, "moved", 2), (31, "moved", 2), (32, "moved", 4), (10, "again", 1), schema=PARTS)
    out = B.merge_window(path, first.schema, batch, ["id"], ["p"], "p in (2, 3)")
    got = rows_of(out, "id", "v", "p")
    # Partition 3 lost all its rows; outside the window nothing is matched.
    assert [r for r in got if r[0] >= 30] == [(30, "moved", 2), (31, "moved", 2), (32, "moved", 4)]
    assert [r for r in got if r[0] == 10] == [(10, "again", 1), (10, "v10", 1)] and len(got) == 10
    after = written(out)
    # The files of partition 1 are as they were, next to one more.
    (one,) = [f for f in before if f.endswith("p=1")]
    assert before[one] < after[one] and not untouched(before, after)
    again = B.merge_window(path, first.schema, df(spark, (20, "x", 2), schema=PARTS), ["id"], ["p"], "p = 2")
    assert {"p=1", "p=3", "p=4"} <= untouched(after, written(again)) and rows_of(again.where("id = 20"), "v") == [("x",)]


def test_windows_of_any_labels(spark, folder):
    path, names = folder(), ["10:30", "a/b", None, "%3A", "x" * 200, "\u00e9 =", "*", "null"]
    rows = [(i, name, i) for i, name in enumerate(names)]
    first = write_partitioned(df(spark, *rows, schema=PARTS), path, ["v"])
    assert rows_of(first, "id", "v") == [(i, name) for i, name in enumerate(names)]
    batch = df(spark, (1, "10:30", 9), (3, "*", 9), (2, None, 9), schema=PARTS)
    out = B.merge_window(path, first.schema, batch, ["id"], ["v"], F.col("v").isin("a/b", "10:30", "%3A") | F.col("v").isNull())
    want = [(0, "10:30", 0), (1, "10:30", 9), (2, None, 9), (3, "*", 9)] + [(i, n, i) for i, n in enumerate(names) if i > 3]
    assert rows_of(out, "id", "v", "p") == rows_of(df(spark, *want, schema=PARTS))


def test_merge_leaves_parts_it_does_not_touch(spark, folder):
    root = folder()
    rows = [(i, "old", 0) for i in range(200)]
    # The first load lays the table out by key.
    first = B.build_incremental(root, df(spark, *rows), "seq", ["id"], "merge")
    before = written(first)
    assert len(before) == 8 and all(re.search("/__part=[0-7]$", f) for f in before)
    out = B.build_incremental(root, df(spark, (7, "new", 1), (500, "more", 1)), None, ["id"], "merge")
    after = written(out)
    assert out.count() == 201 and rows_of(out.where("id = 7"), "v") == [("new",)]
    assert len(after) == 8 and 6 <= len(untouched(before, after)) < 8
    # The same batch again changes no row.
    again = B.build_incremental(root, df(spark, (7, "new", 1), (500, "more", 1)), None, ["id"], "merge")
    assert rows_of(again) == rows_of(B.read_table(spark, root)) and again.count() == 201
    out = B.build_incremental(root, df(spark, (7, "x", 1), (7, "y", 1)), None, ["id"], "delete+insert")
    assert rows_of(out.where("id = 7"), "v") == [("x",), ("y",)] and out.count() == 202
    out = B.build_incremental(root, df(spark, (7, "z", 1)), None, None, "append")
    assert rows_of(out.where("id = 7"), "v") == [("x",), ("y",), ("z",)]


def test_a_table_of_another_layout_is_divided_once(spark, folder):
    root = folder()
    B.build_incremental(root, df(spark, (1, "a", 1), (2, "b", 2)))
    B.build_incremental(root, df(spark, (3, "c", 3)))
    out = B.build_incremental(root, df(spark, (1, "A", 9)), None, ["id"], "merge")
    assert rows_of(out, "id", "v") == [(1, "A"), (2, "b"), (3, "c")]
    out = B.build_incremental(root, df(spark, (4, "b", 9)), None, ["v"], "merge")
    assert rows_of(out, "id", "v") == [(1, "A"), (3, "c"), (4, "b")]
    folders = [r.folder for r in B.loads(spark, root).orderBy("load").collect()]
    assert folders == ["data-0", "data-0", "data-2", "data-3"]


def test_a_load_that_did_not_finish_is_not_seen(spark, folder):
    root = folder()
    B.build_incremental(root, df(spark, (1, "a", 1)), "seq")
    df(spark, (2, "half", 2)).write.parquet(f"{root}/data-0/__load=1")
    assert B.read_table(spark, root).count() == 1
    assert rows_of(B.build_incremental(root, df(spark, (2, "whole", 2)), "seq"), "id", "v") == [(1, "a"), (2, "whole")]
    with pytest.raises(LookupError):
        B.read_table(spark, folder())


def test_columns_must_fit(spark, folder):
    root = folder()
    B.build_incremental(root, df(spark, (1, "a", 1)), None, ["id"], "merge")
    with pytest.raises(ValueError, match="seq: missing"):
        B.build_incremental(root, df(spark, (1, "a", 1)).drop("seq"), None, ["id"], "merge")


def test_repeated_key_without_an_order_is_an_error(spark, folder):
    root = folder()
    B.build_incremental(root, df(spark, (1, "a", 1)))
    with pytest.raises(ValueError, match="repeated"):
        B.build_incremental(root, df(spark, (2, "b", 1), (2, "c", 1)), None, ["id"], "merge")
    both = df(spark, (2, "b", 1), (2, "c", 2), (None, "n", 1), (None, "n", 1))
    assert rows_of(B.build_incremental(root, both, None, ["id"], "merge", ["seq"]), "v") == [("a",), ("c",), ("n",), ("n",)]


def test_watermark_comes_from_the_history(spark, folder):
    root = folder()
    B.build_incremental(root, df(spark, (1, "a", 5)), "seq")
    assert B.last_load(spark, root).watermark == "5"
    B.build_incremental(root, df(spark, (2, "b", 4), (3, "c", 9)), "seq")
    assert B.last_load(spark, root).watermark == "9" and B.read_table(spark, root).count() == 2
    B.build_incremental(root, df(spark, (4, "d", 9)), "seq")
    assert B.last_load(spark, root).watermark == "9" and B.read_table(spark, root).count() == 2


def test_gate_stops_errors_and_lets_warnings_pass(spark, folder):
    rows = df(spark, (1, "a", -1), (2, None, 1))
    path = folder()
    checks = {"v": (lambda d: not_null(d, "v"), "warn"), "seq": (lambda d: is_positive(d, "seq"), "error")}
    verdicts = B.gated_publish(rows, checks, lambda d: d.write.parquet(path))
    assert rows_of(verdicts, "check", "failures", "status") == [("seq", 1, "error"), ("v", 1, "warn")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    B.gated_publish(rows, {"v": checks["v"]}, lambda d: d.write.parquet(path))
    assert spark.read.parquet(path).count() == 2


def test_publish_switches_only_when_checked(spark, folder):
    root = folder()
    checks = {"v": (lambda d: not_null(d, "v"),)}
    B.publish(df(spark, (1, "a", 1)), checks, root)
    B.publish(df(spark, (2, None, 1)), checks, root)
    assert rows_of(V.as_of_version(spark, root), "id") == [(1,)]
    B.publish(df(spark, (3, "c", 1)), checks, root)
    assert rows_of(V.as_of_version(spark, root), "id") == [(3,)]


def test_audit_records_success_and_failure(spark, folder):
    audit, path = folder(), folder()
    clock = iter(dt.datetime(2024, 1, 1, h) for h in range(9))
    B.audited("good", lambda: B.build_table(spark.range(4), path), audit, "r1", lambda: next(clock))

    def broken():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        B.audited("bad", broken, audit, "r1", lambda: next(clock))
    assert rows_of(spark.read.parquet(audit), "name", "row_count", "status", "started_at", "ended_at") == [
        ("bad", None, "error", dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 1, 3)),
        ("good", 4, "success", dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 1)),
    ]


def test_schema_names():
    assert B.schema_name(None, "analytics", "dev") == "analytics"
    assert B.schema_name(" finance ", "analytics", "prod") == "finance"
    assert B.schema_name("finance", "analytics", "dev") == "analytics_finance"


def test_model_versions_live_side_by_side(spark):
    v1, v2 = spark.range(2), spark.range(3).withColumn("x", F.lit(1))
    assert B.register_versions(spark, "m", {1: v1, 2: v2}, 2).columns == ["id", "x"]
    assert spark.table("m_v1").count() == 2 and spark.table("m").count() == 3
