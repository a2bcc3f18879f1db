"""Histories of changing rows."""

from __future__ import annotations

import datetime as dt

from quern.plans import history as H
from quern.plans.project import project
from quern.queries import frames
from quern.queries.registry import query
from quern.session import new_folder

FIRST_RUN, SECOND_RUN = dt.datetime(2024, 2, 1), dt.datetime(2024, 4, 1)


def history_sql(changed: str, first: str, second: str) -> str:
    """Both states merged into versions. `changed` compares a (state 1) and b (state 2)."""
    row_id = "md5(CAST({0}.id AS VARCHAR) || '|' || CAST({1} AS VARCHAR))"
    return f"""(SELECT a.id, a.customer_id, a.plan, a.status, a.updated_at, {row_id.format('a', first)} AS dbt_scd_id,
    {first} AS dbt_updated_at, {first} AS dbt_valid_from, CASE WHEN {changed} THEN {second} END AS dbt_valid_to
    FROM {frames.SUBSCRIPTIONS_1} a LEFT JOIN {frames.SUBSCRIPTIONS_2} b ON a.id = b.id UNION ALL
    SELECT b.id, b.customer_id, b.plan, b.status, b.updated_at, {row_id.format('b', second)}, {second}, {second}, NULL
    FROM {frames.SUBSCRIPTIONS_2} b LEFT JOIN {frames.SUBSCRIPTIONS_1} a ON a.id = b.id
    WHERE a.id IS NULL OR {changed})"""


BY_TIME = history_sql("b.updated_at > a.updated_at", "a.updated_at", "b.updated_at")
BY_CHECK = history_sql(
    "(b.plan IS DISTINCT FROM a.plan OR b.status IS DISTINCT FROM a.status) AND b.id IS NOT NULL",
    "TIMESTAMP '2024-02-01 00:00:00'",
    "TIMESTAMP '2024-04-01 00:00:00'",
)


def by_time(spark, sf):
    first = H.snapshot_timestamp(None, frames.subscriptions(spark, sf, 1), "id", "updated_at")
    return H.snapshot_timestamp(first, frames.subscriptions(spark, sf, 2), "id", "updated_at")


def by_check(spark, sf, cols):
    first = H.snapshot_check(None, frames.subscriptions(spark, sf, 1), "id", cols, FIRST_RUN)
    return H.snapshot_check(first, frames.subscriptions(spark, sf, 2), "id", cols, SECOND_RUN)


@query("scd2_timestamp", f"SELECT * FROM {BY_TIME}")
def scd2_timestamp(spark, sf):
    return by_time(spark, sf)


@query("current_subscriptions", f"""SELECT id AS subscription_id, customer_id, plan, status FROM {BY_TIME}
    WHERE dbt_valid_to IS NULL""")
def current_subscriptions(spark, sf):
    """The mart over a stored history: the open version of every subscription."""
    root = new_folder(spark, "subscriptions")
    for state, run_at in ((1, FIRST_RUN), (2, SECOND_RUN)):
        stored = H.store_history(frames.subscriptions(spark, sf, state), root, "id", "updated_at", run_at=run_at)
    return project({"subscription_history": stored})["dim_current_subscriptions"]


@query("scd2_stored", f"SELECT * FROM {BY_TIME}")
def scd2_stored(spark, sf):
    root = new_folder(spark, "history")
    H.store_history(frames.subscriptions(spark, sf, 1), root, "id", "updated_at")
    return H.store_history(frames.subscriptions(spark, sf, 2), root, "id", "updated_at")


@query("scd2_check_cols", f"SELECT * FROM {BY_CHECK}")
def scd2_check_cols(spark, sf):
    return by_check(spark, sf, ["plan", "status"])


# The columns that change between the states change together, so "all" finds the same versions.
@query("scd2_check_all", f"SELECT * FROM {BY_CHECK}")
def scd2_check_all(spark, sf):
    return by_check(spark, sf, "all")


@query("scd2_current", f"SELECT id, plan, status, dbt_valid_from FROM {BY_TIME} WHERE dbt_valid_to IS NULL")
def scd2_current(spark, sf):
    return H.current_rows(by_time(spark, sf)).select("id", "plan", "status", H.VALID_FROM)


@query(
    "scd2_closed_count",
    f"SELECT dbt_valid_to AS closed_at, count(*) AS closed FROM {BY_TIME} WHERE dbt_valid_to IS NOT NULL GROUP BY 1",
)
def scd2_closed_count(spark, sf):
    return H.closed_counts(by_time(spark, sf))
