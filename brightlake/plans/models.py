"""The three SQL models: revenue trends (W10), top products (W9), customer LTV."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightlake.functions.money import div_round, pct_change, share_pct
from brightlake.functions.rules import rfm_segment
from brightlake.operators.ntile import distributed_ntile, range_partitions
from brightlake.operators.rank import group_totals, join_null_safe, rank_table
from brightlake.session import written


def revenue_trends(daily: DataFrame, frame_days: int = 7, lag_rows: int = 30,
                   by_range: bool = False) -> DataFrame:
    """7-row rolling avg/sum (rounded 2), value 30 rows back, growth %.

    The frame counts *rows* like the model (missing days stretch it); pass
    ``by_range=True`` for a calendar-day frame. One row per day means the
    single ordered window holds calendar-bounded data.
    """
    order = F.col("date")
    if by_range:
        w = Window.orderBy(F.unix_date("date")).rangeBetween(-(frame_days - 1), 0)
    else:
        w = Window.orderBy(order).rowsBetween(-(frame_days - 1), 0)
    lagw = Window.orderBy(order)
    prev = F.lag("total_revenue", lag_rows).over(lagw)
    out = (daily
           .withColumn("_sum7", F.sum("total_revenue").over(w))
           .withColumn("_n7", F.count("total_revenue").over(w))
           .withColumn("_prev", prev))
    return out.select(
        "date", "total_orders", "total_revenue", "avg_order", "unique_customers", "top_category",
        div_round("_sum7", "_n7", 2).alias("revenue_7d_avg"),
        F.round("_sum7", 2).alias("revenue_7d_sum"),
        F.when(F.col("_prev") > 0, pct_change("total_revenue", "_prev", 2)).alias("mom_growth_pct"))


def top_products(perf: DataFrame) -> DataFrame:
    """W6 + W7 + W9: revenue and volume RANK per period and revenue share.

    Descending ranks put NULLs first, as the model's SQL engine does. No window
    is partitioned by period: the ranks come from the range-partitioned
    numbering of ``rank_table`` over the slim columns and the period total from
    an aggregate, so one busy period is spread over many tasks.
    """
    # Read by both numberings and the final join: the aggregate is written once, and counted
    # from its footers for both.
    base = written(perf, "top-products")
    parts = range_partitions(base.sparkSession, base.count())
    by_rev = rank_table(base, ["period"], "revenue", "revenue_rank", ["product_id"], num_partitions=parts)
    by_vol = rank_table(base, ["period"], "units_sold", "volume_rank", ["product_id"], num_partitions=parts)
    totals = group_totals(base, ["period"], "revenue", "_period_revenue")
    x = join_null_safe(base, by_rev, ["period", "revenue"])
    x = join_null_safe(x, by_vol, ["period", "units_sold"])
    x = join_null_safe(x, totals, ["period"])
    return x.select(
        "product_id", "product_name", "category", "period", "units_sold", "revenue",
        "avg_price",
        F.round(F.col("return_rate") * 100, 2).alias("return_rate_pct"),
        "revenue_rank", "volume_rank",
        share_pct("revenue", "_period_revenue", 2).alias("revenue_share_pct"))


def customer_ltv(segments: DataFrame, best_is_high: bool = False) -> DataFrame:
    """W8 + W11: monetary / frequency / recency quartiles, RFM score and segment.

    Quartile 1 is the *highest* spend (descending NTILE), as in the model;
    ``best_is_high=True`` flips it; ``customer_id`` breaks ties. Each quartile is an
    exact distributed NTILE over slim columns. Rows are numbered once and joined back by
    that number, so rows with a null or a repeated id stay one row each.
    """
    def o(c):
        col = F.col(c)
        return col.asc_nulls_last() if best_is_high else col.desc_nulls_last()
    x = base = written(segments.withColumn("_row", F.monotonically_increasing_id()), "customer-ltv")
    for name, column in (("monetary_quartile", "total_spent"), ("frequency_quartile", "order_count"),
                         ("recency_quartile", "last_order_at")):
        tiles = distributed_ntile(base.select("_row", "customer_id", column), 4,
                                  [o(column), F.col("customer_id").asc(), F.col("_row").asc()], name)
        x = x.join(tiles.select("_row", name), "_row")
    m, f, r = F.col("monetary_quartile"), F.col("frequency_quartile"), F.col("recency_quartile")
    return x.select(
        "customer_id", "segment",
        rfm_segment(m, f, r).alias("rfm_segment"),
        (m + f + r).alias("rfm_score"),
        "total_spent", "order_count",
        div_round("total_spent", "order_count", 2).alias("avg_order_value"),
        "last_order_at",
        F.round("clv_score", 4).alias("clv_score"),
        "monetary_quartile", "frequency_quartile", "recency_quartile")
