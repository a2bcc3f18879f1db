"""What the optimizer makes of the queries."""

import pytest
from pyspark.sql import functions as F

from quern.operators import joins as J
from quern.operators import rows
from quern.operators.aggregates import sum_by
from quern.sources import readers, writers
from quern.sources.tables import table

SF = "/root/testdata/sf0.001"


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    orders = rows.where_equal(table(spark, SF, "orders"), "o_orderstatus", "F")
    plan = plan_of(sum_by(orders, ["o_custkey"], "o_totalprice", "revenue"))
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
    assert plan.count("Exchange") == 1


def test_static_pruning(spark, folder):
    path = folder()
    writers.write_partitioned(table(spark, SF, "events").select("event_id", "event_type"), path, ["event_type"])
    df = readers.read_where(spark, path, "event_type = 'click'")
    assert "PartitionFilters: [isnotnull(event_type" in plan_of(df)


def test_broadcast_join_does_not_move_the_fact(spark):
    joined = J.join_small(table(spark, SF, "lineitem"), table(spark, SF, "part"), [("l_partkey", "p_partkey")])
    plan = plan_of(joined, run=True)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_sort_merge_hint(spark):
    joined = J.join_large(table(spark, SF, "lineitem"), table(spark, SF, "orders"), [("l_orderkey", "o_orderkey")])
    assert "SortMergeJoin" in plan_of(joined)


def test_bucketed_join_has_no_exchange(spark, folder):
    # A third of the lines on one order.
    key = F.when(F.col("l_linenumber") < 3, F.lit(0)).otherwise(F.col("l_orderkey")).cast("bigint")
    items = table(spark, SF, "lineitem").select(key.alias("k"), "l_orderkey", "l_linenumber", "l_quantity")
    orders = table(spark, SF, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    fact, dim = writers.write_bucketed_pair(items, orders, "k", ["l_orderkey", "l_linenumber"], limit=500)
    joined = fact.hint("merge").join(dim, ["k", "__salt"])
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == items.join(orders, "k").count()
    salts = fact.groupBy("k").agg(F.count_distinct("__salt").alias("n")).where("n > 1").collect()
    assert [(r.k, r.n > 2) for r in salts] == [(0, True)]


def test_dynamic_pruning(spark, folder):
    items = table(spark, SF, "lineitem").select("l_orderkey", "l_returnflag")
    fact = writers.write_partitioned(items, folder(), ["l_returnflag"])
    dim = spark.createDataFrame([("A", "returned"), ("N", "none"), ("R", "refused")], "l_returnflag string, label string")
    joined = J.star_join(fact, dim, "l_returnflag", "label = 'returned'")
    assert "dynamicpruning" in plan_of(joined)
    assert joined.count() == items.where("l_returnflag = 'A'").count()


def test_partitioned_write_makes_few_files(spark, folder):
    orders = table(spark, SF, "orders").repartition(16).select("o_orderkey", "o_orderstatus")
    out = writers.write_partitioned(orders, folder(), ["o_orderstatus"])
    assert len(out.inputFiles()) <= 6 and out.count() == orders.count()


def test_compact_write_has_the_files_asked_for(spark, folder):
    path = folder()
    out = writers.write_compact(table(spark, SF, "events").select("event_id", "value"), path, 3, "zstd")
    assert len(out.inputFiles()) == 3 and all("zstd" in f for f in out.inputFiles())


def test_two_filters_become_one(spark):
    kept = rows.where_all(table(spark, SF, "part"), ["p_size > 3", "p_size < 10"])
    assert plan_of(kept).count("Filter (") == 1


@pytest.mark.parametrize("mode", ["overwrite", "append", "ignore", "error"])
def test_save_modes(spark, folder, mode):
    path = folder()
    writers.write(spark.range(3), path)
    if mode == "error":
        with pytest.raises(Exception, match="already exists"):
            writers.write(spark.range(2), path, mode)
        return
    writers.write(spark.range(2), path, mode)
    assert spark.read.parquet(path).count() == {"overwrite": 2, "append": 5, "ignore": 3}[mode]


def test_export_and_import_restore_every_table(spark, folder):
    path = folder()
    spark.range(4).createOrReplaceTempView("kept_a")
    spark.range(6).createOrReplaceTempView("kept_b")
    writers.export_all(spark, path, only=["kept_a", "kept_b"])
    spark.catalog.dropTempView("kept_a")
    assert writers.import_all(spark, path) == ["kept_a", "kept_b"]
    assert spark.table("kept_a").count() == 4


def test_unknown_source_is_refused(spark):
    sources = readers.Sources().declare("raw", "numbers", lambda s: s.range(3))
    assert sources.source(spark, "raw", "numbers").count() == 3
    with pytest.raises(LookupError, match="raw.numbers"):
        sources.source(spark, "raw", "letters")
