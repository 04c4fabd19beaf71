import datetime as dt
from decimal import Decimal

from brightlake.plans import ops, serving
from brightlake.sources import sinks


def runs(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [("b2s", "silver", s, 10, 9, 100, None, t + dt.timedelta(minutes=i), t)
            for i, s in enumerate(["success", "failed", "success", "running"])]
    return spark.createDataFrame(rows, ops.RUN_SCHEMA)


def test_run_history(spark):
    r = runs(spark)
    assert [x.started_at.minute for x in serving.recent_runs(r, 2).collect()] == [3, 2]
    c = serving.run_status_counts(r).first()
    assert (c.success, c.failed, c.running) == (2, 1, 1)
    kept = ops.retain(r, "started_at", dt.datetime(2026, 1, 31, 0, 2), 30)
    assert kept.count() == 2                       # minutes 2 and 3 are within 30 days


def test_namespace(spark):
    sinks.create_namespace(spark, "brightlake_test_ns")
    assert "brightlake_test_ns" in [d.name for d in spark.catalog.listDatabases()]


def feats(spark):
    rows = [(1, 0.39), (2, 0.4), (3, 0.4001), (4, 0.7), (5, 0.7001), (6, 0.7001)]
    return spark.createDataFrame(
        [(cid, 1, Decimal("10.00"), Decimal(str(p)), Decimal("5.00"), "x", 3,
          dt.datetime(2026, 1, 1)) for cid, p in rows],
        "customer_id long, order_count_30d int, avg_basket_size decimal(18,2), "
        "churn_probability decimal(10,4), clv_score decimal(18,2), preferred_category string, "
        "days_since_last int, computed_at timestamp_ntz")


def test_churn_edges(spark):
    f = feats(spark)
    s = serving.ml_summary(f).first()
    assert (s.high_risk_count, s.medium_risk_count, s.low_risk_count) == (2, 3, 1)
    levels = {cid: serving.customer_ml(f, cid).first().risk_level for cid in (2, 3, 5)}
    assert levels == {2: "low", 3: "medium", 5: "high"}          # 0.4 is low here
    top = [r.customer_id for r in serving.churn_risk(f, 0.5, 2).collect()]
    assert top == [5, 6]                                          # tie broken by id
    olap = serving.olap_churn_stats(f).first()
    assert (olap.high_risk, olap.medium_risk, olap.low_risk) == (2, 3, 1)


def test_summary_without_recent_days(spark):
    daily = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 1, Decimal("5.00"), Decimal("5.00"), 1, "x")],
        "date date, total_orders long, total_revenue decimal(28,2), avg_order decimal(10,2), "
        "unique_customers long, top_category string")
    segs = spark.createDataFrame([(1, "vip"), (2, "at_risk"), (3, "vip")],
                                 "customer_id long, segment string")
    s = serving.summary(daily, segs, "2026-01-01").first()
    assert (s.total_revenue, s.total_orders, s.unique_customers) == (0, 0, 0)
    assert (s.vip_customers, s.at_risk_customers) == (2, 1)
