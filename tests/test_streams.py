import datetime as dt
import subprocess
import sys

import duckdb
import pytest
from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import functions as F

from __spark_entry__ import ORACLES, QUERIES
from quern.session import STATE_STORE
from quern.sources.tables import SCHEMAS
from quern.streaming import streams as S
from tests import data
from tests.conftest import rows_of
from tools.check import compare

SCHEMA = data.TRANSACTIONS[0]


def feed_of(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def feed(spark, folder):
    path = folder("feed")
    feed_of(spark, path, data.TRANSACTIONS[1])
    return path


def run(stream, folder):
    return S.run_available(stream, folder("sink"), folder("checkpoint"))


def at(minute, second=0):
    return dt.datetime(2024, 4, 1, 12, minute, second)


def test_filter(spark, feed, folder):
    out = run(S.stream_filter(spark, feed, SCHEMA, "amount > 500"), folder)
    assert rows_of(out, "tx_id") == [("TX1002",), ("TX1004",), ("TX1006",), ("TX1008",)]


def test_csv_stream(spark, folder):
    path = folder()
    spark.createDataFrame([("a", 1.5)], "k string, v double").write.option("header", "true").csv(path)
    out = run(S.read_stream(spark, path, "k string, v double", "csv"), folder)
    assert rows_of(out) == [("a", 1.5)]


def windows(spark, feed, delay="10 minutes"):
    totals = [F.sum("amount").alias("total"), F.count(F.lit(1)).alias("n")]
    return S.tumbling(S.read_stream(spark, feed, SCHEMA), "ts", "5 minutes", delay, ["merchant"], totals)


def test_open_windows_are_not_emitted(spark, feed, folder):
    assert run(windows(spark, feed), folder).count() == 0


def test_windows_are_emitted_once_finished(spark, feed, folder):
    sink, checkpoint = folder(), folder()
    S.run_available(windows(spark, feed), sink, checkpoint)
    feed_of(spark, feed, [("TX2000", "1", 1.0, "Later", dt.datetime(2024, 4, 1, 13, 0))])
    out = S.run_available(windows(spark, feed), sink, checkpoint)
    assert out.count() == 8
    assert (at(0), at(5), "CoffeeShop", 35.5, 1) in rows_of(out)
    assert (at(5), at(10), "OffshoreTransfer", 2500.0, 1) in rows_of(out)


def test_late_rows_do_not_change_finished_windows(spark, feed, folder):
    sink, checkpoint = folder(), folder()
    feed_of(spark, feed, [("TX2000", "1", 1.0, "Later", dt.datetime(2024, 4, 1, 13, 0))])
    S.run_available(windows(spark, feed), sink, checkpoint)
    late = [("TX0001", "1", 99.0, "CoffeeShop", at(1)), ("TX2001", "1", 2.0, "Later", dt.datetime(2024, 4, 1, 13, 1))]
    feed_of(spark, feed, late)
    feed_of(spark, feed, [("TX3000", "1", 1.0, "Last", dt.datetime(2024, 4, 1, 14, 0))])
    out = S.run_available(windows(spark, feed), sink, checkpoint)
    assert [r for r in rows_of(out, "merchant", "total", "n") if r[0] in ("CoffeeShop", "Later")] == [
        ("CoffeeShop", 35.5, 1), ("Later", 3.0, 2),
    ]


def test_sliding_windows_overlap(spark, feed, folder):
    sink, checkpoint = folder(), folder()
    feed_of(spark, feed, [("TX2000", "1", 1.0, "Later", dt.datetime(2024, 4, 1, 13, 0))])
    stream = S.sliding(
        S.read_stream(spark, feed, SCHEMA), "ts", "10 minutes", "5 minutes", "10 minutes", [], [F.count(F.lit(1)).alias("n")]
    )
    out = S.run_available(stream, sink, checkpoint)
    assert rows_of(out, "window_start", "n") == [
        (dt.datetime(2024, 4, 1, 11, 55), 4), (at(0), 8), (at(5), 4),
    ]


def test_complete_and_update_give_the_same_totals(spark, feed, folder):
    def totals():
        return S.stream_totals(S.read_stream(spark, feed, SCHEMA), ["user_id"], [F.sum("amount").alias("total")])

    update_root, update_checkpoint = folder(), folder()
    S.stream_upsert(totals(), ["user_id"], update_root, update_checkpoint)
    feed_of(spark, feed, [("TX2000", "1", 100.0, "Later", at(30)), ("TX2001", "9", 5.0, "Later", at(30))])
    update = S.stream_upsert(totals(), ["user_id"], update_root, update_checkpoint)
    complete = S.stream_complete(totals(), folder(), folder())
    want = spark.read.schema(SCHEMA).parquet(feed).groupBy("user_id").agg(F.sum("amount"))
    assert rows_of(update) == rows_of(complete) == rows_of(want)


def test_restart_reads_nothing_twice(spark, feed, folder):
    sink, checkpoint = folder(), folder()

    def go():
        return S.run_available(S.read_stream(spark, feed, SCHEMA, files_per_trigger=1), sink, checkpoint)

    assert go().count() == 8 and go().count() == 8
    feed_of(spark, feed, [("TX2000", "1", 1.0, "Later", at(30))])
    assert go().count() == 9


def test_dedup(spark, feed, folder):
    again = [data.TRANSACTIONS[1][0], ("TX1002", "2", 1200.0, "LuxuryJewelry", at(2))]
    feed_of(spark, feed, again)
    source = S.read_stream(spark, feed, SCHEMA)
    exact = run(S.dedup(source, ["tx_id"], "ts", "30 minutes"), folder)
    assert exact.count() == 9  # the same id at another time is another event
    by_id = run(S.dedup(source, ["tx_id"], "ts", "30 minutes", same_time=False), folder)
    assert by_id.count() == 8


def test_stream_join_equals_batch_rule(spark, feed, folder):
    def side(prefix):
        return S.read_stream(spark, feed, SCHEMA).select(
            F.col("tx_id").alias(f"{prefix}_id"), "user_id", F.col("ts").alias(f"{prefix}_ts")
        )

    out = run(S.join_streams(side("a"), side("b"), ["user_id"], "a_ts", "b_ts", 290, "10 minutes"), folder)
    rows = data.TRANSACTIONS[1]
    want = sorted(
        (x[0], y[0]) for x in rows for y in rows
        if x[1] == y[1] and x[4] <= y[4] <= x[4] + dt.timedelta(seconds=290)
    )
    assert rows_of(out, "a_id", "b_id") == want and ("TX1002", "TX1006") in want


def test_rules(spark, feed, folder):
    listed = data.frame(spark, data.BLACKLIST)
    out = run(S.score(S.read_stream(spark, feed, SCHEMA), listed, "amount", "merchant", "ts"), folder)
    decisions = dict(rows_of(out, "tx_id", "fraud_decision"))
    blocked = {k for k, v in decisions.items() if v == S.BLOCKED}
    assert blocked == {"TX1002", "TX1006", "TX1008"}
    assert {k for k, v in decisions.items() if v == S.REVIEW} == {"TX1004"}
    assert sum(v == S.APPROVED for v in decisions.values()) == 4
    assert rows_of(out.where("tx_id = 'TX1001'"), "merchant_risk", "merchant_category") == [(0.1, "STANDARD")]


def test_stream_commits_every_batch_once(spark, feed, folder):
    root, checkpoint = folder(), folder()
    feed_of(spark, feed, [("TX2000", "1", 1.0, "Later", at(30))])

    def go():
        return S.stream_commit(S.read_stream(spark, feed, SCHEMA, files_per_trigger=1), root, checkpoint)

    assert go().count() == 9 and go().count() == 9
    from quern.plans.versions import history

    assert rows_of(history(spark, root), "batch_id") == [(0,), (1,)]


def state_totals(spark, feed, ttl_seconds=None, files_per_trigger=None):
    source = S.read_stream(spark, feed, SCHEMA, files_per_trigger=files_per_trigger)
    return S.running_totals(source, ["user_id"], {"cents": F.round(F.col("amount") * 100)}, ttl_seconds)


def test_totals_in_state_equal_plain_totals_over_restarts(spark, feed, folder):
    root, checkpoint = folder(), folder()
    S.stream_upsert(state_totals(spark, feed, 3600), ["user_id"], root, checkpoint, False)
    again = S.stream_upsert(state_totals(spark, feed, 3600), ["user_id"], root, checkpoint, False)
    want = spark.read.schema(SCHEMA).parquet(feed).groupBy("user_id")
    want = want.agg(F.count("*").alias("events"), F.sum(F.round(F.col("amount") * 100)).cast("bigint").alias("cents"))
    assert rows_of(again, "user_id", "events", "cents") == rows_of(want)
    feed_of(spark, feed, [("TX2000", "1", 100.0, "Later", at(30)), ("TX2001", "9", None, "Later", at(30))])
    later = S.stream_upsert(state_totals(spark, feed, 3600), ["user_id"], root, checkpoint, False)
    want = spark.read.schema(SCHEMA).parquet(feed).groupBy("user_id").agg(
        F.count("*"), F.coalesce(F.sum(F.round(F.col("amount") * 100)), F.lit(0)).cast("bigint")
    )
    assert rows_of(later, "user_id", "events", "cents") == rows_of(want) and ("9", 1, 0) in rows_of(later, "user_id", "events", "cents")


def test_only_changed_keys_are_emitted_and_idle_ones_forgotten(spark, feed, folder):
    checkpoint, seen = folder(), []

    def write(rows, number):
        seen.append({r.user_id: r.events for r in rows.collect()})

    S.run_batches(state_totals(spark, feed, 1), write, checkpoint, "update", False)
    import time

    time.sleep(2)
    feed_of(spark, feed, [("TX2000", "1", 1.0, "Later", at(30)), ("TX2001", None, 1.0, "Later", at(30))])
    S.run_batches(state_totals(spark, feed, 1), write, checkpoint, "update", False)
    assert sum(seen[0].values()) == 8 and seen[0]["1"] > 1 and seen[-1] == {"1": 1, None: 1}
    with pytest.raises(ValueError, match="twice"):
        S.running_totals(S.read_stream(spark, feed, SCHEMA), ["user_id"], {"user_id": F.lit(1)})


@pytest.fixture
def default_store(spark):
    """The state store of a session that names none."""
    former = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, former.replace("RocksDB", "HDFSBacked"))
    yield
    spark.conf.set(STATE_STORE, former)


def test_state_totals_equal_their_sql_on_odd_events_in_a_plain_session(spark, default_store, folder):
    sf, db = folder("sf"), duckdb.connect()
    early, late = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 30)
    rows = [
        (1, early, 1, "view", 2.5, None), (2, late, 1, "view", 1.005, None), (3, None, 1, "view", -9.915, None),
        (4, early, 2, "view", None, None), (5, early, 3, "view", None, None), (6, late, 3, "view", 0.1, None),
        (7, early, None, "view", 1.0, None), (8, late, None, "view", 4.0, None), (9, None, None, "view", None, None),
        (10, late, 2**53 + 1, "view", 7.0, None), (11, early, 2**53, "view", 8.0, None), (12, None, 4, "view", 5.0, None),
    ]
    spark.createDataFrame(rows, SCHEMAS["events"]).coalesce(1).write.parquet(f"{sf}/events.parquet")
    db.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet/*.parquet')")
    store = spark.conf.get(STATE_STORE)
    assert compare(QUERIES["stream_state_totals"](spark, sf), db, ORACLES["stream_state_totals"]) == ""
    assert spark.conf.get(STATE_STORE) == store


def test_upsert_replaces_the_null_key(spark, feed, folder):
    root, checkpoint = folder(), folder()
    for minute in (30, 31):
        feed_of(spark, feed, [(f"TX{minute}", None, 1.0, "Later", at(minute))])
        counted = S.stream_totals(S.read_stream(spark, feed, SCHEMA), ["user_id"], [F.count(F.lit(1)).alias("n")])
        out = S.stream_upsert(counted, ["user_id"], root, checkpoint)
    assert rows_of(out.where("user_id IS NULL"), "n") == [(2,)]


def test_state_is_loaded_without_the_library(spark):
    sent = S._totals(["k"], ["n"], None)
    code = f"""
import sys, pickle
processor = pickle.loads({CloudPickleSerializer().dumps(sent)!r})
assert 'quern' not in sys.modules and processor.close() is None
"""
    subprocess.run([sys.executable, "-I", "-c", code], check=True)


def test_late_rows_are_put_aside_once(spark, folder):
    feed, root, checkpoint = folder(), folder(), folder()
    closes = S.window_end("ts", 300)

    def go():
        return S.set_late_aside(S.read_stream(spark, feed, SCHEMA), "ts", "10 minutes", root, checkpoint, closes)

    spark.createDataFrame([], SCHEMA).write.parquet(feed)
    assert [side.count() for side in go()] == [0, 0]
    feed_of(spark, feed, [("a", "1", 1.0, "m", at(0)), ("b", "1", 1.0, "m", at(20)), ("n", "1", 1.0, "m", None)])
    go()
    # The watermark is 12:10: the window that ends there has closed, the next has not.
    feed_of(spark, feed, [("c", "1", 1.0, "m", at(9, 59)), ("d", "1", 1.0, "m", at(10)), ("c", "1", 1.0, "m", at(9, 59)), ("e", "1", 1.0, "m", at(45))])
    for _ in range(2):
        kept, late = go()
        assert rows_of(kept, "tx_id") == [("a",), ("b",), ("d",), ("e",), ("n",)] and rows_of(late, "tx_id") == [("c",), ("c",)]
        assert kept.schema["ts"].dataType.simpleString() == "timestamp"
    marks = S.late_marks(spark, root).where("kept + late > 0")
    assert rows_of(marks, "kept", "late") == [(3, 0), (2, 2)] or rows_of(marks, "kept", "late") == [(2, 2), (3, 0)]


def test_a_batch_run_again_replaces_what_it_wrote(spark, feed, folder, monkeypatch):
    root, checkpoint = folder(), folder()

    def go():
        return S.set_late_aside(S.read_stream(spark, feed, SCHEMA), "ts", "10 minutes", root, checkpoint)

    real = S.replace_parts

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(S, "replace_parts", lost)
    with pytest.raises(Exception, match="driver lost"):
        go()
    assert S.late_marks(spark, root).isEmpty()
    monkeypatch.setattr(S, "replace_parts", real)
    kept, late = go()
    assert kept.count() == 8 and late.count() == 0
