"""User functions, partitions, skew."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.expressions import code_labels
from quern.functions.masking import add_tax, mask_name
from quern.operators import layout as L
from quern.operators.skew import parts_for
from quern.queries import frames
from quern.queries.registry import plain, query
from quern.session import new_folder
from quern.sources.tables import table

# Labels of the status codes, and the bucket of each nation.
CODE_LABELS = {200: "OK_SUCCESS", 404: "NOT_FOUND_ERROR", 500: "INTERNAL_SERVER_ERROR"}
UNKNOWN = "UNKNOWN"
REGIONS = {0: [f"NATION_{i}" for i in range(15)], 1: [f"NATION_{i}" for i in range(15, 21)]}
OTHER = 2
ROWS_PER_PARTITION = 5_000_000


@query(
    "udf_mask_name",
    """SELECT p_partkey, CASE WHEN contains(p_name, ' ') THEN split_part(p_name, ' ', 1) || ' ' ||
    substr(split_part(p_name, ' ', 2), 1, 1) || '.' ELSE p_name END AS masked_name FROM part""",
)
def udf_mask_name(spark, sf):
    return table(spark, sf, "part").select("p_partkey", mask_name("p_name").alias("masked_name"))


@query("udf_vectorised", "SELECT o_orderkey, o_totalprice * 1.0825::DOUBLE AS with_tax FROM orders")
def udf_vectorised(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", add_tax("o_totalprice").alias("with_tax"))


@query(
    "lookup_partition_map",
    f"""SELECT log_id, status_code, CASE status_code WHEN 200 THEN 'OK_SUCCESS' WHEN 404 THEN 'NOT_FOUND_ERROR'
    WHEN 500 THEN 'INTERNAL_SERVER_ERROR' ELSE 'UNKNOWN' END AS description, endpoint FROM {frames.WEB_LOGS}""",
)
def lookup_partition_map(spark, sf):
    logs = frames.web_logs(spark, sf)
    label = code_labels("status_code", CODE_LABELS, UNKNOWN).alias("description")
    return logs.select("log_id", "status_code", label, "endpoint")


@query(
    "error_counter",
    f"SELECT count(*) AS seen, count(*) FILTER (status_code >= 400) AS matched FROM {frames.WEB_LOGS}",
)
def error_counter(spark, sf):
    logs, watch = L.observe_errors(frames.web_logs(spark, sf), F.col("status_code") >= 400)
    label = code_labels("status_code", CODE_LABELS, UNKNOWN).alias("description")
    logs.select("log_id", label).write.parquet(new_folder(spark, "labelled"))
    counts = watch.get
    return spark.createDataFrame([(counts["seen"], counts["matched"])], "seen bigint, matched bigint")


@query(
    "even_squares",
    "SELECT event_id AS value, CAST(event_id AS DOUBLE) * CAST(event_id AS DOUBLE) AS square FROM events WHERE event_id % 2 = 0",
)
def even_squares(spark, sf):
    return plain(L.even_squares(table(spark, sf, "events"), "event_id"))


@query(
    "custom_partition",
    """SELECT CASE WHEN c_nationkey < 15 THEN 0 WHEN c_nationkey < 21 THEN 1 ELSE 2 END AS bucket, count(*) AS row_count
    FROM customer GROUP BY 1""",
)
def custom_partition(spark, sf):
    people = frames.users(spark, sf).select("id", L.region_buckets("country", REGIONS, OTHER).alias("bucket"))
    per_bucket = parts_for(people, ROWS_PER_PARTITION, at_least=4)
    placed = L.partition_by_bucket(people, "bucket", 3, per_bucket, ["id"])
    sizes = L.partition_sizes(placed, "bucket")
    return sizes.groupBy("bucket").agg(F.sum("row_count").alias("row_count"))


@query("repartition_coalesce", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def repartition_coalesce(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    parts = parts_for(orders, ROWS_PER_PARTITION, at_least=4)
    return L.coalesced(L.repartitioned(orders, 4 * parts, ["o_orderkey"]), parts)


@query(
    "reuse_cached",
    """SELECT count(*) AS row_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem
    WHERE l_returnflag = 'A'""",
)
def reuse_cached(spark, sf):
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    rows, total = L.with_cached(returned, [lambda df: df.count(), lambda df: df.agg(F.sum("price")).first()[0]])
    return spark.createDataFrame([(rows, None if total is None else float(total))], "row_count bigint, total double")


@query(
    "skew_report",
    """SELECT o_custkey, rows_per_key, median_rows, rows_per_key > median_rows * 1.5 AS is_hot FROM (
    SELECT o_custkey, count(*) AS rows_per_key FROM orders GROUP BY 1),
    (SELECT CAST(median(n) AS DOUBLE) AS median_rows FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey))""",
)
def skew_report(spark, sf):
    return L.skew_report(table(spark, sf, "orders"), "o_custkey", 1.5)


@query(
    "skew_hot_list",
    """SELECT l_quantity, count(*) AS rows_per_key FROM lineitem GROUP BY 1
    HAVING count(*) > 0.02 * (SELECT count(*) FROM lineitem)""",
)
def skew_hot_list(spark, sf):
    return L.hot_list(table(spark, sf, "lineitem"), "l_quantity", 0.02)
