import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brightlake.operators.ntile import distributed_ntile, global_row_number
from brightlake.operators.rank import rank_within_group, with_group_total
from brightlake.plans import gold, models

D0 = dt.date(2026, 1, 1)


def lines(spark, rows):
    """rows: (order_id, customer_id, category, amount, status, date)"""
    data = [(o, c, 1, "p", cat, Decimal(str(a)) if a is not None else None, 1,
             Decimal(str(a)) if a is not None else None, s, dt.datetime.combine(d, dt.time()), d)
            for o, c, cat, a, s, d in rows]
    return spark.createDataFrame(
        data, "order_id string, customer_id long, product_id long, product_name string, "
              "category string, unit_price decimal(18,2), quantity long, "
              "total_amount decimal(18,2), status string, created_at timestamp_ntz, "
              "order_date date")


def test_daily_sales_and_category_tie(spark):
    rows = [("1", 1, "b", 10, "completed", D0), ("2", 2, "a", 10, "completed", D0),
            ("3", 1, "a", 0.01, "refunded", D0), ("4", 1, "c", 5.005, "completed", D0)]
    out = gold.daily_sales(lines(spark, rows)).first()
    assert out.total_orders == 3 and out.unique_customers == 2
    assert out.top_category == "a" or out.top_category == "b"
    assert out.top_category == "a"                       # tie -> smallest category
    assert out.total_revenue == Decimal("25.01")


def test_revenue_trends_rows_vs_range(spark):
    days = [D0 + dt.timedelta(days=i) for i in range(40) if i not in (10, 11, 12)]
    daily = spark.createDataFrame(
        [(d, 1, Decimal("0.00") if i == 6 else Decimal(i + 1), Decimal(1), 1, "x")
         for i, d in enumerate(days)],
        "date date, total_orders long, total_revenue decimal(28,2), avg_order decimal(10,2), "
        "unique_customers long, top_category string")
    rows = {r.date: r for r in models.revenue_trends(daily).collect()}
    rng = {r.date: r for r in models.revenue_trends(daily, by_range=True).collect()}
    d = D0 + dt.timedelta(days=14)            # frame crosses the 3 missing days
    assert rows[d].revenue_7d_sum != rng[d].revenue_7d_sum
    first = rows[D0]
    assert first.revenue_7d_avg == first.total_revenue and first.mom_growth_pct is None
    zero_base = days[36]                      # 30 rows after the zero-revenue day
    assert rows[zero_base].mom_growth_pct is None
    assert rows[days[35]].mom_growth_pct is not None


def test_top_products_ties_nulls_zero(spark):
    perf = spark.createDataFrame(
        [(1, "p1", "c", "2026-01", 5, Decimal("10.00"), Decimal(1), Decimal("0.1000")),
         (2, "p2", "c", "2026-01", 7, Decimal("10.00"), Decimal(1), Decimal("0")),
         (3, "p3", "c", "2026-01", 1, None, Decimal(1), Decimal("0")),
         (4, "p4", "c", "2026-02", 1, Decimal("0.00"), Decimal(1), Decimal("0"))],
        "product_id long, product_name string, category string, period string, units_sold int, "
        "revenue decimal(28,2), avg_price decimal(10,2), return_rate decimal(5,4)")
    out = {r.product_id: r for r in models.top_products(perf).collect()}
    assert out[3].revenue_rank == 1                       # NULL first in DESC
    assert out[1].revenue_rank == out[2].revenue_rank == 2
    assert out[2].volume_rank == 1
    assert out[1].revenue_share_pct == Decimal("50.00")
    assert out[4].revenue_share_pct is None               # period total 0
    assert out[1].return_rate_pct == Decimal("10.00")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 10, 11, 997])
def test_distributed_ntile_matches_ntile(spark, n):
    df = spark.range(n).select(F.col("id"), (F.col("id") % 7).alias("v"),
                               F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 3)
                               .alias("w"))
    order = [F.col("v").desc_nulls_last(), F.col("w").desc_nulls_last(), F.col("id")]
    expect = df.withColumn("q", F.ntile(4).over(Window.orderBy(*order)))
    got = distributed_ntile(df, 4, order, "q", num_partitions=3)
    assert sorted(expect.collect()) == sorted(got.collect())


def test_global_row_number_is_dense(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 13)
    out = global_row_number(df, [F.col("k"), F.col("id")], "rn", num_partitions=5)
    rns = sorted(r.rn for r in out.collect())
    assert rns == list(range(1, 1001))


@pytest.mark.parametrize("parts", [1, 3, 7])
@pytest.mark.parametrize("descending,nulls_first", [(True, True), (True, False), (False, True)])
def test_rank_within_group_matches_window_rank(spark, parts, descending, nulls_first):
    # group 0 holds a third of all rows; value 5 is a hot tie; NULL values and a NULL group
    df = spark.range(900).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 97 == 1, None)
         .otherwise(F.col("id") % 11).alias("g"),
        F.when(F.col("id") % 13 == 0, None).when(F.col("id") % 4 == 0, 5)
         .otherwise(F.col("id") % 17).alias("v"))
    v = F.col("v")
    if descending:
        vo = v.desc_nulls_first() if nulls_first else v.desc_nulls_last()
    else:
        vo = v.asc_nulls_first() if nulls_first else v.asc_nulls_last()
    expect = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(vo)))
    got = rank_within_group(df, ["g"], "v", "r", ["id"], descending=descending,
                            nulls_first=nulls_first, num_partitions=parts)
    assert sorted(expect.collect()) == sorted(got.select(*expect.columns).collect())


def test_with_group_total_matches_window_sum(spark):
    df = spark.range(300).select(
        F.col("id"), F.when(F.col("id") % 29 == 0, None).otherwise(F.col("id") % 4).alias("g"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("v"))
    expect = df.withColumn("t", F.sum("v").over(Window.partitionBy("g")))
    got = with_group_total(df, ["g"], "v", "t")
    assert sorted(expect.collect()) == sorted(got.select(*expect.columns).collect())


def test_segment_edges(spark):
    as_of = D0
    rows = [("1", 1, "a", 3000, "completed", D0), ("2", 2, "a", 3000.01, "completed", D0),
            ("3", 3, "a", 1000, "completed", D0), ("4", 4, "a", 1000.01, "completed", D0),
            ("5", 5, "a", 10, "completed", D0 - dt.timedelta(days=181)),
            ("6", 6, "a", 10, "completed", D0 - dt.timedelta(days=180)),
            ("7", 7, "a", 10, "completed", D0 - dt.timedelta(days=1)),
            ("8", 7, "a", 10, "completed", D0 - dt.timedelta(days=2)),
            ("9", 8, "a", 10, "completed", D0 + dt.timedelta(days=1)),   # future: days = -1
            ("10", 99, "a", 10, "completed", D0),                          # unknown customer
            ("11", 9, "a", 10, "cancelled", D0)]
    customers = spark.createDataFrame([(i,) for i in range(1, 11)], "customer_id long")
    seg = {r.customer_id: r for r in gold.customer_segments(lines(spark, rows), customers,
                                                            as_of).collect()}
    assert 99 not in seg and len(seg) == 10
    assert [seg[i].segment for i in (1, 2, 3, 4)] == ["premium", "vip", "new", "premium"]
    assert seg[5].segment == "at_risk" and seg[6].segment == "new"
    assert seg[7].segment == "regular"
    assert seg[8].clv_score == 0 and seg[8].days_since_last == -1   # division by zero -> 0
    for cid in (9, 10):                                             # no (valid) orders
        r = seg[cid]
        assert (r.total_spent, r.order_count, r.clv_score, r.segment) == (0, 0, 0, "new")
        assert r.last_order_at is None and r.days_since_last is None


def test_customer_ltv_inverted_quartiles(spark):
    seg = spark.createDataFrame(
        [(i, "regular", Decimal(i * 10), i, dt.datetime(2026, 1, i), Decimal(1))
         for i in range(1, 9)],
        "customer_id long, segment string, total_spent decimal(28,2), order_count int, "
        "last_order_at timestamp_ntz, clv_score decimal(38,4)")
    out = {r.customer_id: r for r in models.customer_ltv(seg).collect()}
    assert out[8].monetary_quartile == 1 and out[1].monetary_quartile == 4
    assert out[1].rfm_segment == "champion"          # lowest spender, as the model labels
    flipped = {r.customer_id: r for r in
               models.customer_ltv(seg, True).collect()}
    assert flipped[8].rfm_segment == "champion"


def test_models_match_plain_windows_on_driver_tables(spark):
    from brightlake import registry
    sf = "/root/testdata/sf0.001"
    perf = registry._perf(spark, sf)
    got = models.top_products(perf).select("product_id", "period", "revenue_rank", "volume_rank")
    w = Window.partitionBy("period")
    expect = perf.select("product_id", "period",
                         F.rank().over(w.orderBy(F.col("revenue").desc_nulls_first())),
                         F.rank().over(w.orderBy(F.col("units_sold").desc_nulls_first())))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))
    seg = registry._segments(spark, sf)
    got = models.customer_ltv(seg).select("customer_id", "monetary_quartile", "recency_quartile")
    expect = seg.select("customer_id", *[F.ntile(4).over(Window.orderBy(
        F.col(c).desc_nulls_last(), "customer_id")) for c in ("total_spent", "last_order_at")])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))


def test_div_round_holds_large_counts(spark):
    from brightlake.functions.money import div_round
    row = spark.range(1).select(div_round(F.lit("30000000000.00").cast("decimal(28,2)"),
                                          F.lit(20_000_000_000), 2).alias("x")).first()
    assert row.x == Decimal("1.50")


def test_customer_ltv_keeps_null_and_repeated_ids(spark):
    rows = [(1, Decimal(10)), (1, Decimal(20)), (2, Decimal(30)), (None, Decimal(40)), (None, None)]
    seg = spark.createDataFrame(
        [(k, "regular", spent, 1, dt.datetime(2026, 1, 1 + i), Decimal(1)) for i, (k, spent) in enumerate(rows)],
        "customer_id long, segment string, total_spent decimal(28,2), order_count int, "
        "last_order_at timestamp_ntz, clv_score decimal(38,4)")
    out = models.customer_ltv(seg).collect()
    assert sorted(str((r.customer_id, r.total_spent and int(r.total_spent))) for r in out) == \
        sorted(str((k, spent and int(spent))) for k, spent in rows)
    assert sorted(r.monetary_quartile for r in out) == [1, 1, 2, 3, 4]


def test_top_products_writes_its_rows_once(spark, monkeypatch):
    from brightlake.operators import ntile
    perf = spark.range(40).selectExpr(
        "id AS product_id", "'n' AS product_name", "'c' AS category", "'2026-01' AS period", "int(id % 5) AS units_sold",
        "cast(id % 7 AS decimal(14,2)) AS revenue", "cast(1 AS decimal(14,2)) AS avg_price",
        "cast(0 AS decimal(5,4)) AS return_rate")
    names, write = [], ntile.written
    for module in (ntile, models):
        monkeypatch.setattr(module, "written", lambda df, name: (names.append(name), write(df, name))[1])
    out = models.top_products(perf).collect()
    assert sorted(names) == ["row-number", "row-number", "top-products"]
    assert {r.product_id: r.volume_rank for r in out} == {i: 1 + 8 * (4 - i % 5) for i in range(40)}
