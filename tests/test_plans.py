"""Plan-shape checks: the scale properties the design relies on."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from brightlake.operators.asof import asof_join
from brightlake.operators.dedupe import first_by_key
from brightlake.operators.ntile import distributed_ntile

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_aggregates_are_partial_and_scans_pruned(spark):
    df = E.queries()["daily_sales"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    p = plan(df)
    assert "partial_sum" in p and "partial_count" in p
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scans and all("l_tax" not in s and "l_shipdate" not in s for s in scans)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dedupe_combines_map_side(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    p = plan(first_by_key(df, ["k"], ["id"]))
    assert "partial_min" in p


def test_ntile_never_uses_the_window_function(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 7)
    out = distributed_ntile(df, 4, [F.col("v"), F.col("id")], "q", num_partitions=4)
    p = plan(out)
    assert "ntile" not in p.lower()
    assert "SinglePartition" not in p.split("Window")[-1] or "row-number" in p


def test_asof_window_is_partitioned_by_entity_and_bucket(spark):
    f = spark.createDataFrame([(1, dt.datetime(2026, 1, 1), 1.0)], "k long, fts timestamp_ntz, v double")
    s = spark.createDataFrame([(1, dt.datetime(2026, 1, 1, 1))], "k long, t timestamp_ntz")
    out = asof_join(s, f, "k", "t", "fts", ["v"], dt.timedelta(hours=2))
    p = plan(out)
    assert "hashpartitioning(_k" in p and "_b" in p.split("hashpartitioning(_k", 1)[1][:40]
    assert out.first().v == 1.0


def test_daily_sales_scans_once_and_recent_days_reach_the_scan(spark):
    from brightlake import registry
    sf = "/root/testdata/sf0.001"
    full = registry.QUERIES["daily_sales"](spark, sf)._jdf.queryExecution().executedPlan()
    assert full.toString().count("FileScan parquet") == 3     # lineitem, orders, part once each
    recent = registry.QUERIES["q_daily_sales"](spark, sf)._jdf.queryExecution().executedPlan()
    orders_scan = [ln for ln in recent.toString().split("\n") if "FileScan parquet [o_" in ln]
    assert orders_scan and all("o_orderdate" in ln.split("DataFilters")[1].split("]")[0]
                               for ln in orders_scan)


def test_top_products_has_no_window_by_period(spark):
    from brightlake import registry
    from brightlake.plans import models
    perf = registry._perf(spark, SF)
    assert "windowspecdefinition(period" not in plan(models.top_products(perf))


def test_latest_period_reaches_the_scan_of_orders(spark):
    from brightlake import registry
    p = plan(registry._top_latest(spark, SF))   # the aggregate is written; only its columns stay
    assert "lineitem" not in p


def test_stream_batch_reads_touched_days_only(spark, scratch):
    from brightlake.streaming.incremental import in_days
    df = spark.range(24).selectExpr("id", "make_date(2026, int(id % 12 + 1), 5) AS order_date")
    df.withColumn("_month", F.date_format("order_date", "yyyy-MM")).write.partitionBy("_month").parquet(
        f"{scratch}/cells")
    cells = spark.read.schema("id long, order_date date, _month string").parquet(f"{scratch}/cells")
    one = in_days(cells, ["2026-03-05"])
    assert one.count() == 2
    assert "_month" in plan(one).split("PartitionFilters: [")[1].split("]")[0]
    assert "order_date" in plan(one).split("PushedFilters: [")[1].split("]")[0]


def test_as_of_read_opens_one_snapshot(spark, scratch):
    from brightlake.sources import landing
    for day in ("20260101", "20260201", "20260301"):
        spark.range(3).coalesce(1).write.parquet(f"{scratch}/snapshot_{day}.parquet")
    files = landing.read_as_of(spark, scratch, "2026-02-15").inputFiles()
    assert len(files) == 1 and "20260201" in files[0]
    assert landing.read_as_of(spark, scratch, "2025-01-01").count() == 0


def test_first_of_ids_sorts_rows_once_by_id(spark):
    """Before, all rows were also sorted ahead of the shuffle, in tasks of any size."""
    from brightlake.operators.dedupe import first_of_ids
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 3, None),
                                (None, 0, "n"), (None, 0, "m")], "k string, id int, v string")
    out = first_of_ids(df, "k", ["id"])
    p = plan(out)
    assert p.count("Sort [") == 1 and p.count("Exchange hashpartitioning") == 1
    assert sorted(out.collect()) == [("a", 1, "y"), ("b", 3, None)]
    expected = first_by_key(df, ["k"], ["id"]).filter("k is not null")
    assert sorted(expected.collect()) == sorted(out.collect())
