"""Streams over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.expressions import money
from quern.queries import frames
from quern.queries.registry import plain, query
from quern.session import new_folder
from quern.sources.rows import inline_rows
from quern.sources.tables import SCHEMAS, table
from quern.streaming import streams as S

# Fixed rows of the watch list, and the factor that brings event values into the range of the rules.
WATCHLIST = [("error", 0.98, "HIGH_RISK"), ("signup", 0.75, "MONITORED"), ("refund", 0.95, "HIGH_RISK")]
AMOUNT_FACTOR = 10


def run(stream, label):
    """Everything that has arrived, through a checkpointed sink."""
    spark = stream.sparkSession
    return S.run_available(stream, new_folder(spark, label), new_folder(spark, f"{label}-checkpoint"))


def back_to_ntz(df, *cols):
    """Event times without time zone again, as the table has them."""
    for col in cols:
        df = df.withColumn(col, F.col(col).cast("timestamp_ntz"))
    return df


def add_feed(spark, sf, feed, predicate):
    """Leave some of the events in a feed folder, as a producer would."""
    table(spark, sf, "events").where(predicate).write.mode("append").parquet(feed)


@query("stream_filter", "SELECT event_id, user_id, event_type, value FROM events WHERE value > 50")
def stream_filter(spark, sf):
    kept = S.stream_filter(spark, f"{sf}/events*.parquet", SCHEMAS["events"], F.col("value") > 50, files_per_trigger=1000)
    return run(kept.select("event_id", "user_id", "event_type", "value"), "stream_filter")



def totals():
    return [F.count(F.lit(1)).alias("events"), F.sum(money("value")).alias("total")]


BY_USER = """SELECT user_id, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY user_id"""


@query("stream_agg_complete", BY_USER)
def stream_agg_complete(spark, sf):
    counted = S.stream_totals(frames.event_feed(spark, sf), ["user_id"], totals())
    return plain(S.stream_complete(counted, new_folder(spark, "complete"), new_folder(spark, "checkpoint")))


@query("stream_agg_update", BY_USER)
def stream_agg_update(spark, sf):
    feed, root, checkpoint = new_folder(spark, "feed"), new_folder(spark, "update"), new_folder(spark, "checkpoint")
    out = None
    # Two arrivals: the second changes only the users it holds.
    for part in ("ts < timestamp_ntz'2024-01-29 00:00:00'", "ts >= timestamp_ntz'2024-01-29 00:00:00'"):
        add_feed(spark, sf, feed, part)
        counted = S.stream_totals(S.read_stream(spark, feed, SCHEMAS["events"]), ["user_id"], totals())
        out = S.stream_upsert(counted, ["user_id"], root, checkpoint)
    return plain(out)


@query("stream_state_totals", BY_USER)
def stream_state_totals(spark, sf):
    """As above with state of its own, which forgets a user after a day without events. Events without a time come last."""
    feed, root, checkpoint = new_folder(spark, "feed"), new_folder(spark, "state"), new_folder(spark, "checkpoint")
    # Rounded as the SQL's cast does it: half cents of the double away from zero.
    amounts = {"cents": F.round(F.col("value") * 100), "valued": F.col("value").isNotNull()}
    out = None
    for part in ("ts < timestamp_ntz'2024-01-29 00:00:00'", "ts >= timestamp_ntz'2024-01-29 00:00:00' OR ts IS NULL"):
        add_feed(spark, sf, feed, part)
        events = S.read_stream(spark, feed, SCHEMAS["events"])
        out = S.stream_upsert(S.running_totals(events, ["user_id"], amounts, ttl_seconds=86_400), ["user_id"], root, checkpoint, False)
    return out.select("user_id", "events", F.when(F.col("valued") > 0, F.col("cents") / 100).alias("total"))


@query(
    "stream_tumbling",
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00') AS window_start,
    time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00') + INTERVAL 5 MINUTE AS window_end,
    event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events
    GROUP BY 1, 2, 3 HAVING window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
)
def stream_tumbling(spark, sf):
    windows = S.tumbling(frames.event_feed(spark, sf), "ts", "5 minutes", "10 minutes", ["event_type"], totals())
    return plain(run(windows, "tumbling"))


@query(
    "stream_sliding",
    """SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS events,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (SELECT event_type, value,
    time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00') - k * INTERVAL 5 MINUTE AS window_start
    FROM events, (VALUES (0), (1)) t(k)) GROUP BY 1, 2, 3
    HAVING window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
)
def stream_sliding(spark, sf):
    windows = S.sliding(
        frames.event_feed(spark, sf), "ts", "10 minutes", "5 minutes", "10 minutes", ["event_type"], totals()
    )
    return plain(run(windows, "sliding"))


@query(
    "stream_late_data",
    """WITH a AS (SELECT * FROM events WHERE event_type <> 'error'),
    closed AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM a), ended AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM events),
    kept AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, ts FROM a UNION ALL
    SELECT date_trunc('day', ts)::TIMESTAMP, ts FROM events WHERE event_type = 'error'
    AND date_trunc('day', ts) + INTERVAL 1 DAY > (SELECT mark FROM closed))
    SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS events FROM kept GROUP BY 1, 2
    HAVING window_end <= (SELECT mark FROM ended)""",
)
def stream_late_data(spark, sf):
    """Errors arrive a month late: the days that were finished by then are left as they were."""
    feed, sink, checkpoint = new_folder(spark, "feed"), new_folder(spark, "late"), new_folder(spark, "checkpoint")
    out = None
    for part in ("event_type <> 'error'", "event_type = 'error'"):
        add_feed(spark, sf, feed, part)
        source = S.read_stream(spark, feed, SCHEMAS["events"])
        days = S.tumbling(source, "ts", "1 day", "1 day", [], [F.count(F.lit(1)).alias("events")])
        out = S.run_available(days, sink, checkpoint)
    return out


@query(
    "stream_late_aside",
    """WITH mark AS (SELECT max(ts) - INTERVAL 1 DAY AS ended FROM events WHERE event_type <> 'error'),
    marked AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type = 'error' AND
    date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT ended FROM mark) AS late FROM events)
    SELECT window_start, count(*) FILTER (NOT late) AS kept, count(*) FILTER (late) AS late FROM marked GROUP BY 1""",
)
def stream_late_aside(spark, sf):
    """The same late errors, put aside next to what was in time."""
    feed, root, checkpoint = new_folder(spark, "feed"), new_folder(spark, "aside"), new_folder(spark, "checkpoint")
    day = F.date_trunc("day", F.col("ts"))
    for part in ("event_type <> 'error'", "event_type = 'error'"):
        add_feed(spark, sf, feed, part)
        source = S.read_stream(spark, feed, SCHEMAS["events"])
        kept, late = S.set_late_aside(source, "ts", "1 day", root, checkpoint, S.window_end("ts", 86_400))
    both = kept.select("ts", F.lit(False).alias("late")).unionByName(late.select("ts", F.lit(True).alias("late")))
    counted = both.groupBy(day.alias("window_start")).agg(F.count_if(~F.col("late")).alias("kept"), F.count_if("late").alias("late"))
    return back_to_ntz(counted, "window_start")


@query(
    "stream_static_join",
    """SELECT event_id, event_type, risk_score, category AS threat_level FROM events JOIN (VALUES ('error', 0.98::DOUBLE,
    'HIGH_RISK'), ('signup', 0.75::DOUBLE, 'MONITORED'), ('refund', 0.95::DOUBLE, 'HIGH_RISK'))
    w(kind, risk_score, category) ON event_type = kind""",
)
def stream_static_join(spark, sf):
    listed = inline_rows(spark, WATCHLIST, "event_type string, risk_score double, category string")
    joined = S.enrich(frames.event_feed(spark, sf), listed, "event_type")
    return run(joined.select("event_id", "event_type", "risk_score", F.col("category").alias("threat_level")), "static")


@query(
    "stream_stream_join",
    """SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id, v.ts AS view_ts, p.ts AS purchase_ts
    FROM events v JOIN events p ON v.user_id = p.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 1 HOUR
    WHERE v.event_type = 'view' AND p.event_type = 'purchase'""",
)
def stream_stream_join(spark, sf):
    views = frames.event_feed(spark, sf).where("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts")
    )
    purchases = frames.event_feed(spark, sf).where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts")
    )
    pairs = S.join_streams(views, purchases, ["user_id"], "view_ts", "purchase_ts", 3600, "2 hours")
    return back_to_ntz(run(pairs, "pairs"), "view_ts", "purchase_ts")


@query("stream_dedup", "SELECT event_id, ts, event_type FROM events")
def stream_dedup(spark, sf):
    feed = new_folder(spark, "feed")
    for _ in range(2):  # every event is delivered twice
        add_feed(spark, sf, feed, "true")
    once = S.dedup(S.read_stream(spark, feed, SCHEMAS["events"]), ["event_id"], "ts", "30 minutes")
    return back_to_ntz(run(once.select("event_id", "ts", "event_type"), "dedup"), "ts")


@query("stream_checkpoint", "SELECT event_id, ts, event_type, value FROM events")
def stream_checkpoint(spark, sf):
    feed, sink, checkpoint = new_folder(spark, "feed"), new_folder(spark, "sink"), new_folder(spark, "checkpoint")
    out = None
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        add_feed(spark, sf, feed, part)
        source = S.read_stream(spark, feed, SCHEMAS["events"])
        out = S.run_available(source.select("event_id", "ts", "event_type", "value"), sink, checkpoint)
    return out


@query(
    "stream_rules",
    """SELECT event_id, event_type, amount, merchant_risk, merchant_category, CASE WHEN amount >= 1000 OR merchant_risk >= 0.70
    THEN 'BLOCKED_CRITICAL' WHEN amount >= 500 THEN 'FLAGGED_REVIEW' ELSE 'APPROVED' END AS fraud_decision FROM (
    SELECT event_id, event_type, value * 10 AS amount, coalesce(risk_score, 0.1::DOUBLE) AS merchant_risk,
    coalesce(category, 'STANDARD') AS merchant_category FROM events LEFT JOIN (VALUES ('error', 0.98::DOUBLE, 'HIGH_RISK'),
    ('signup', 0.75::DOUBLE, 'MONITORED'), ('refund', 0.95::DOUBLE, 'HIGH_RISK')) w(kind, risk_score, category)
    ON event_type = kind)""",
)
def stream_rules(spark, sf):
    listed = inline_rows(spark, WATCHLIST, "event_type string, risk_score double, category string")
    feed = frames.event_feed(spark, sf).withColumn("amount", F.col("value") * AMOUNT_FACTOR)
    scored = S.score(feed, listed, "amount", "event_type", "ts")
    return run(
        scored.select("event_id", "event_type", "amount", "merchant_risk", "merchant_category", "fraud_decision"), "rules"
    )
