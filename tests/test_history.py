import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from quern.plans import history as H
from quern.plans import versions as V
from tests.conftest import rows_of

SCHEMA = "id bigint, plan string, updated_at timestamp_ntz"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def subs(spark, *rows):
    return spark.createDataFrame([(i, p, day(d)) for i, p, d in rows], SCHEMA)


def first(spark):
    return H.snapshot_timestamp(None, subs(spark, (1, "basic", 0), (2, "pro", 1), (3, "basic", 2)), "id", "updated_at")


def versions(hist):
    return rows_of(hist, "id", "plan", H.VALID_FROM, H.VALID_TO)


def test_first_run_opens_every_row(spark):
    hist = first(spark)
    assert versions(hist) == [(1, "basic", day(0), None), (2, "pro", day(1), None), (3, "basic", day(2), None)]
    assert hist.columns[-4:] == list(H.META)
    assert hist.select(H.SCD_ID).distinct().count() == 3


def test_change_closes_and_opens(spark):
    hist = H.snapshot_timestamp(first(spark), subs(spark, (1, "pro", 60), (2, "pro", 1), (6, "new", 5)), "id", "updated_at")
    assert versions(hist) == [
        (1, "basic", day(0), day(60)), (1, "pro", day(60), None), (2, "pro", day(1), None), (3, "basic", day(2), None),
        (6, "new", day(5), None),
    ]
    assert rows_of(H.closed_counts(hist)) == [(day(60), 1)]
    assert rows_of(H.current_rows(hist), "id") == [(1,), (2,), (3,), (6,)]


def test_same_state_again_changes_nothing(spark):
    hist = first(spark)
    again = H.snapshot_timestamp(hist, subs(spark, (1, "basic", 0), (2, "pro", 1), (3, "basic", 2)), "id", "updated_at")
    assert rows_of(again) == rows_of(hist)


def test_older_update_is_ignored_and_reported(spark):
    hist, back = first(spark), subs(spark, (3, "older", 1), (1, "basic", 0))
    assert versions(H.snapshot_timestamp(hist, back, "id", "updated_at")) == versions(hist)
    assert rows_of(H.moved_back(hist, back, "id", "updated_at"), "id") == [(3,)]


def test_deleted_rows_stay_open_unless_asked(spark):
    cur = subs(spark, (1, "basic", 0))
    assert H.current_rows(H.snapshot_timestamp(first(spark), cur, "id", "updated_at")).count() == 3
    closed = H.snapshot_timestamp(first(spark), cur, "id", "updated_at", close_deleted=True, run_at=day(90))
    assert rows_of(H.current_rows(closed), "id") == [(1,)]
    assert rows_of(H.closed_counts(closed)) == [(day(90), 2)]


def test_check_compares_nulls_as_values(spark):
    base = spark.createDataFrame([(1, "a", None), (2, None, "x"), (3, "c", "z")], "id bigint, p string, q string")
    hist = H.snapshot_check(None, base, "id", ["p"], day(0))
    moved = spark.createDataFrame([(1, None, None), (2, None, "y"), (3, "c", "z")], "id bigint, p string, q string")
    by_p = H.snapshot_check(hist, moved, "id", ["p"], day(1))
    assert rows_of(by_p.where(F.col(H.VALID_TO).isNotNull()), "id") == [(1,)]
    by_all = H.snapshot_check(hist, moved, "id", "all", day(1))
    assert rows_of(by_all.where(F.col(H.VALID_TO).isNotNull()), "id") == [(1,), (2,)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_runs_keep_one_open_row_and_no_overlap(spark, seed):
    rnd = random.Random(seed)
    state, hist = {}, None
    for run in range(4):
        for key in range(12):
            if rnd.random() < 0.5:
                state[key] = (rnd.choice("abc"), run * 10 + rnd.randrange(10))
        cur = subs(spark, *[(k, p, d) for k, (p, d) in state.items()])
        hist = H.snapshot_timestamp(hist, cur, "id", "updated_at")
        hist = spark.createDataFrame(hist.collect(), hist.schema)
    by_key = {}
    for row in hist.collect():
        by_key.setdefault(row.id, []).append((row[H.VALID_FROM], row[H.VALID_TO], row.plan))
    assert by_key.keys() == state.keys()
    for key, found in by_key.items():
        found.sort(key=lambda v: v[0])
        assert [v[1] is None for v in found] == [False] * (len(found) - 1) + [True]
        assert all(a[1] == b[0] for a, b in zip(found, found[1:]))
        assert found[-1][2] == state[key][0]


def test_stored_history_touches_closed_versions_once(spark, folder):
    root = folder()
    states = [
        subs(spark, (1, "basic", 0), (2, "pro", 1)),
        subs(spark, (1, "pro", 60), (2, "pro", 1), (3, "new", 5)),
        subs(spark, (1, "max", 70), (2, "pro", 1), (3, "new", 5)),
        subs(spark, (1, "max", 70), (2, "pro", 1), (3, "new", 5)),
    ]
    hist = None
    for state in states:
        hist = H.snapshot_timestamp(hist, state, "id", "updated_at")
        stored = H.store_history(state, root, "id", "updated_at")
        assert rows_of(stored, *hist.columns) == rows_of(hist)
    # Each run wrote its open versions and what it closed itself.
    folders = {tuple(re.search("__version=(.)/__state=(.*?)/", f).groups()) for f in stored.inputFiles()}
    assert {n for n, state in folders if state == "closed"} == {"1", "2"}
    assert rows_of(H.stored_history(spark, root, 0)) == rows_of(H.snapshot_timestamp(None, states[0], "id", "updated_at"))


def test_changes_of_a_stored_history(spark, folder):
    root = folder()
    H.store_history(subs(spark, (1, "basic", 0), (2, "pro", 1)), root, "id", "updated_at")
    H.store_history(subs(spark, (1, "pro", 60), (2, "pro", 1)), root, "id", "updated_at")
    feed = V.compare(H.stored_history(spark, root, 0), H.stored_history(spark, root), [H.SCD_ID])
    assert rows_of(feed, V.CHANGE_TYPE, "id", "plan", H.VALID_TO) == [
        ("insert", 1, "pro", None), ("update_postimage", 1, "basic", day(60)), ("update_preimage", 1, "basic", None),
    ]
