"""Versioned tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quern.plans import versions as V
from quern.queries import frames
from quern.queries.registry import query
from quern.session import new_folder
from quern.sources.tables import table
from quern.streaming import streams

DAYS = [dt.datetime(2024, 3, day) for day in (1, 2, 3)]


def accounts(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")


def three_commits(spark, sf) -> str:
    """Even customers; the odd ones appended; then all without every seventh, every fifth changed, and new ones."""
    root = new_folder(spark, "versions")
    every = accounts(spark, sf)
    V.commit(every.where("c_custkey % 2 = 0"), root, "overwrite", DAYS[0])
    V.commit(every.where("c_custkey % 2 = 1"), root, "append", DAYS[1])
    changed = F.when(F.col("c_custkey") % 5 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal"))
    kept = every.where("c_custkey % 7 <> 0").withColumn("c_acctbal", changed)
    new = every.where("c_custkey % 9 = 0").withColumn("c_custkey", -F.col("c_custkey") - 1)
    V.commit(kept.unionByName(new), root, "overwrite", DAYS[2])
    return root


THIRD = """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer WHERE c_custkey % 7 <> 0 UNION ALL
    SELECT -c_custkey - 1, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 9 = 0"""


@query("version_commit", THIRD)
def version_commit(spark, sf):
    return V.as_of_version(spark, three_commits(spark, sf))


@query("version_as_of", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def version_as_of(spark, sf):
    return V.as_of_version(spark, three_commits(spark, sf), 1)


@query("timestamp_as_of", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 2 = 0")
def timestamp_as_of(spark, sf):
    return V.as_of_time(spark, three_commits(spark, sf), dt.datetime(2024, 3, 1, 18, 0))


@query(
    "change_feed",
    """SELECT c_custkey, c_acctbal, c_mktsegment, 'insert' AS _change_type, (c_custkey % 2)::BIGINT AS _commit_version,
    TIMESTAMP '2024-03-01 00:00:00' + (c_custkey % 2) * INTERVAL 1 DAY AS _commit_timestamp FROM customer
    UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, 'delete', 2, TIMESTAMP '2024-03-03 00:00:00' FROM customer
    WHERE c_custkey % 7 = 0
    UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, 'update_preimage', 2, TIMESTAMP '2024-03-03 00:00:00' FROM customer
    WHERE c_custkey % 7 <> 0 AND c_custkey % 5 = 0 AND c_acctbal <> 0
    UNION ALL SELECT c_custkey, 0.0, c_mktsegment, 'update_postimage', 2, TIMESTAMP '2024-03-03 00:00:00' FROM customer
    WHERE c_custkey % 7 <> 0 AND c_custkey % 5 = 0 AND c_acctbal <> 0
    UNION ALL SELECT -c_custkey - 1, c_acctbal, c_mktsegment, 'insert', 2, TIMESTAMP '2024-03-03 00:00:00' FROM customer
    WHERE c_custkey % 9 = 0""",
)
def change_feed(spark, sf):
    return V.change_feed(spark, three_commits(spark, sf), ["c_custkey"])


@query(
    "schema_enforcement",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer""",
)
def schema_enforcement(spark, sf):
    root = new_folder(spark, "widened")
    every = accounts(spark, sf)
    V.commit(every.where("c_custkey % 2 = 0").drop("c_mktsegment"), root, "overwrite", DAYS[0])
    odd = every.where("c_custkey % 2 = 1")
    try:
        V.commit(odd, root, "append", DAYS[1])
    except ValueError:
        V.commit(odd, root, "append", DAYS[1], merge_schema=True)
    return V.as_of_version(spark, root)


@query("stream_to_version", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_to_version(spark, sf):
    feed = frames.event_feed(spark, sf)
    root, checkpoint = new_folder(spark, "stream_versions"), new_folder(spark, "checkpoint")
    streams.stream_commit(feed, root, checkpoint)
    # A second start finds nothing new and commits nothing.
    return streams.stream_commit(feed, root, checkpoint)


@query(
    "version_history",
    """SELECT 0::BIGINT AS version, 'overwrite' AS operation, count(*) FILTER (c_custkey % 2 = 0) AS row_count,
    TIMESTAMP '2024-03-01 00:00:00' AS committed_at FROM customer UNION ALL
    SELECT 1, 'append', count(*) FILTER (c_custkey % 2 = 1), TIMESTAMP '2024-03-02 00:00:00' FROM customer UNION ALL
    SELECT 2, 'overwrite', count(*) FILTER (c_custkey % 7 <> 0) + count(*) FILTER (c_custkey % 9 = 0),
    TIMESTAMP '2024-03-03 00:00:00' FROM customer""",
)
def version_history(spark, sf):
    return V.history(spark, three_commits(spark, sf)).select("version", "operation", "row_count", "committed_at")
