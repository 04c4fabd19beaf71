import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from brightlake.operators.dedupe import latest_by
from brightlake.operators.upsert import upsert
from brightlake.plans import ops
from brightlake.schemas import BRONZE_CUSTOMERS, BRONZE_ORDERS
from brightlake.sources import landing, sinks, tables


def test_latest_by_versions(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 5, "x"), (2, 5, "y")],
                               "k long, v long, payload string")
    out = dict((r.k, r.payload) for r in latest_by(df, ["k"], "v").collect())
    assert out == {1: "b", 2: "y"}                       # equal version: greatest full row


def test_upsert_pairs_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a", 1.0, 10), (2, "b", 2.0, 20), (3, "c", 3.0, 30)],
                                   "k long, name string, score double, n long")
    source = spark.createDataFrame([(2, "B", 9.0, 99), (4, "d", 4.0, 40)],
                                   "k long, name string, score double, n long")
    merged = upsert(target, source, ["k"], ["score", "n"])
    out = {r.k: tuple(r) for r in merged.collect()}
    assert out[1] == (1, "a", 1.0, 10)                  # untouched
    assert out[2] == (2, "b", 9.0, 99)                  # partial update keeps name
    assert out[4] == (4, "d", 4.0, 40)                  # insert
    again = upsert(merged, source, ["k"], ["score", "n"])
    assert sorted(again.collect()) == sorted(merged.collect())


def test_dated_snapshots(spark, scratch):
    for d, seg in (("20260101", "standard"), ("20260105", "premium"), ("20260110", "vip")):
        spark.createDataFrame([(1, "A", "a@x", "FR", seg, None)], BRONZE_CUSTOMERS) \
            .write.parquet(f"{scratch}/customers/snapshot_{d}.parquet")
    path = f"{scratch}/customers"
    assert landing.read_as_of(spark, path, "2025-12-31", BRONZE_CUSTOMERS).count() == 0
    assert landing.read_as_of(spark, path, "2026-01-07", BRONZE_CUSTOMERS).first().segment == "premium"
    assert landing.read_as_of(spark, path, "2026-02-01", BRONZE_CUSTOMERS).first().segment == "vip"
    snaps = {r.snapshot_date: r.row_count for r in landing.list_snapshots(spark, path).collect()}
    assert snaps == {dt.date(2026, 1, 1): 1, dt.date(2026, 1, 5): 1, dt.date(2026, 1, 10): 1}
    latest = latest_by(landing.read_snapshots(spark, path, BRONZE_CUSTOMERS), ["customer_id"],
                       ["_snapshot"])
    assert latest.first().segment == "vip"


def test_partitioned_orders_scan(spark, scratch):
    rows = [("o1", 1, 1, "p", "c", 1.0, 1, 0.0, 1.0, "FR", "completed", "card", "2026-01-02T00:00:00")]
    df = spark.createDataFrame(rows, BRONZE_ORDERS)
    df.write.parquet(f"{scratch}/orders/year=2026/month=1/day=2")
    df.withColumn("order_id", F.lit("o2")).write.parquet(f"{scratch}/orders/year=2026/month=2/day=1")
    got = landing.read_orders(spark, f"{scratch}/orders", BRONZE_ORDERS)
    assert {"year", "month", "day", "_landed_file", "_landed_row"} <= set(got.columns)
    pruned = got.filter((F.col("month") == 2))
    assert [r.order_id for r in pruned.collect()] == ["o2"]
    assert "PartitionFilters: [isnotnull(month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_sinks_and_guard(spark, scratch):
    df = spark.createDataFrame([(1, dt.datetime(2026, 1, 5), "2026-01"), (2, dt.datetime(2026, 2, 5), "2026-02")],
                               "id long, created_at timestamp_ntz, period string")
    sinks.write_monthly(df, f"{scratch}/m")
    assert {"created_month=2026-01-01", "created_month=2026-02-01"} <= set(os.listdir(f"{scratch}/m"))
    sinks.write_partitions(df, f"{scratch}/p")
    sinks.write_partitions(df.filter("id = 2").withColumn("id", F.lit(3)), f"{scratch}/p")
    assert sorted(r.id for r in spark.read.parquet(f"{scratch}/p").collect()) == [1, 3]
    back = spark.read.parquet(f"{scratch}/m")
    sinks.truncate_insert(back.filter("id = 2"), f"{scratch}/m", ["created_month"])   # reads itself
    assert [r.id for r in spark.read.parquet(f"{scratch}/m").collect()] == [2]
    sinks.save_table(df, "saved_orders", ["period"])
    sinks.save_table(df.filter("id = 1"), "saved_orders", ["period"])
    assert [r.id for r in tables.catalog_table(spark, "saved_orders").collect()] == [1]
    spark.sql("DROP TABLE saved_orders")
    sinks.append_rows(df, f"{scratch}/a", "2026-01-01 00:00:00")
    sinks.append_rows(df, f"{scratch}/a", "2026-01-02 00:00:00")
    assert spark.read.parquet(f"{scratch}/a").count() == 4
    sinks.compact(spark.read.parquet(f"{scratch}/a"), f"{scratch}/c", ["id"], file_rows=2)
    assert spark.read.parquet(f"{scratch}/c").count() == 4
    assert len([f for f in os.listdir(f"{scratch}/c") if f.endswith(".parquet")]) == 2


def test_retention_deletes(spark, scratch):
    df = spark.createDataFrame([(1, dt.datetime(2026, 1, 1)), (2, dt.datetime(2026, 1, 30)), (3, None)],
                               "id long, ts timestamp_ntz")
    df.write.parquet(f"{scratch}/e")
    assert ops.apply_retention(spark, f"{scratch}/e", "ts", "2026-02-01", 7) == {"kept": 2, "deleted": 1}
    assert sorted(r.id for r in spark.read.parquet(f"{scratch}/e").collect()) == [2, 3]


def test_run_log_observe_and_ops(spark, scratch):
    df = spark.range(123).withColumn("ts", F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz"))
    run = ops.write_observed(df, f"{scratch}/t", "job", "silver", rows_read=200).first()
    assert (run.status, run.rows_written, run.rows_read) == ("success", 123, 200)
    cat = ops.table_catalog({"t": spark.read.parquet(f"{scratch}/t")}, "silver", "2026-01-02")
    assert cat.first().row_count == 123
    fresh = ops.table_catalog({"t": df.limit(5)}, "silver", "2026-01-03")
    assert ops.refresh_catalog(cat, fresh).first().row_count == 5
    stats = ops.storage_stats(spark, {"silver": f"{scratch}/t"}).first()
    assert stats.files >= 1 and stats.size_bytes > 0
    assert ops.retain(df, "ts", "2026-01-20", 30).count() == 123
    assert ops.expired(df, "ts", "2026-03-01", 30).count() == 123


def test_failed_write_is_logged(spark, scratch):
    df = spark.range(3)
    df.write.parquet(f"{scratch}/exists")
    with pytest.raises(RuntimeError):
        ops.write_observed(df, f"{scratch}/exists", "job", "silver", mode="error",
                           runs_path=f"{scratch}/runs")
    ops.write_observed(df, f"{scratch}/new", "job", "silver", runs_path=f"{scratch}/runs")
    runs = {r.status: r for r in spark.read.parquet(f"{scratch}/runs").collect()}
    assert runs["failed"].rows_written == 0 and runs["failed"].error_msg
    assert runs["success"].rows_written == 3


def test_upsert_partitions_rewrites_only_touched(spark, scratch):
    from brightlake.operators.upsert import upsert_partitions
    path = f"{scratch}/perf"
    base = spark.createDataFrame([("2026-01", 1, 10.0, "a"), ("2026-01", 2, 20.0, "b"),
                                  ("2026-02", 1, 30.0, "a")],
                                 "period string, product_id long, revenue double, name string")
    upsert_partitions(spark, path, base, ["period", "product_id"], "period")
    jan_files = sorted(os.listdir(f"{path}/period=2026-01"))
    src = spark.createDataFrame([("2026-02", 1, 99.0, "A"), ("2026-02", 3, 5.0, "c")],
                                "period string, product_id long, revenue double, name string")
    for _ in range(2):  # idempotent
        upsert_partitions(spark, path, src, ["period", "product_id"], "period", ["revenue"])
    out = {(r.period, r.product_id): (r.revenue, r.name) for r in spark.read.parquet(path).collect()}
    assert out == {("2026-01", 1): (10.0, "a"), ("2026-01", 2): (20.0, "b"),
                   ("2026-02", 1): (99.0, "a"), ("2026-02", 3): (5.0, "c")}
    assert sorted(os.listdir(f"{path}/period=2026-01")) == jan_files   # untouched partition
