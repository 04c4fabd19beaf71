"""Gold aggregates: daily sales, product performance, customer segments.

Every aggregate (hash, or sort where its buffer holds text) combines map-side, so a hot
key (one day, product or customer holding a third of all rows) is folded
inside each map task before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightlake.functions.dates import days_since, month_start, period
from brightlake.functions.money import SUM_MONEY, div_round, ratio_round
from brightlake.functions.rules import (CLV_CAP_SEGMENTS, SEGMENT_THRESHOLDS,
                                        customer_segment)
from brightlake.operators.topk import arg_max_per_group


def daily_sales(orders: DataFrame, statuses=("completed",)) -> DataFrame:
    """A1 + A2 + J1: ``gold.daily_sales`` with money as DECIMAL, in one scan.

    One ``GROUPING SETS ((day, customer), (day, category))`` aggregate (map-side
    combined) gives per-customer and per-category cells of each day. One
    per-day aggregate then reads the customer cells for the totals and the
    distinct customers, and the category cells for the arg-max category
    (ties -> smallest category). The order lines are scanned and joined once,
    and the J1 join disappears.
    """
    return daily_of_cells(day_cells(orders, statuses))


CELL_KEYS = ["order_date", "customer_id", "category", "_gc", "_gk"]


def day_cells(orders: DataFrame, statuses=("completed",)) -> DataFrame:
    """Orders ``n`` and revenue ``rev`` of each (day, customer) and each (day, category).

    Both add up: the cells of several sets of orders merge into those of their union.
    """
    o = orders.filter(F.col("status").isin(list(statuses))) if statuses else orders
    return (o.groupingSets([["order_date", "customer_id"], ["order_date", "category"]],
                           "order_date", "customer_id", "category")
            .agg(F.count("order_id").alias("n"), F.sum("total_amount").alias("rev"),
                 F.grouping("customer_id").alias("_gc"), F.grouping("category").alias("_gk")))


def merge_cells(cells: DataFrame) -> DataFrame:
    """Cells that stand more than once, added up."""
    return cells.groupBy(*CELL_KEYS).agg(
        F.sum("n").alias("n"), F.sum("rev").cast(cells.schema["rev"].dataType).alias("rev"))


def daily_of_cells(cells: DataFrame) -> DataFrame:
    """``gold.daily_sales`` of distinct day cells."""
    cust, cat = F.col("_gc") == 0, F.col("_gk") == 0
    best = F.when(cat & F.col("rev").isNotNull(),
                  F.struct((-F.col("rev")).alias("o"), F.col("category").alias("t")))
    days = (cells.groupBy(F.col("order_date").alias("date"))
                 .agg(F.sum(F.when(cust, F.col("n"))).alias("total_orders"),
                      F.sum(F.when(cust, F.col("rev"))).cast(SUM_MONEY).alias("rev"),
                      F.count(F.when(cust, F.col("customer_id"))).alias("unique_customers"),
                      F.min_by(F.col("category"), best).alias("top_category")))
    return days.select("date", "total_orders",
                       F.round("rev", 2).alias("total_revenue"),
                       div_round("rev", "total_orders", 2).alias("avg_order"),
                       "unique_customers", "top_category")


def product_performance(orders: DataFrame, products: DataFrame | None = None,
                        statuses=None) -> DataFrame:
    """A3 + A4 + J2: product x month units, revenue, avg price, return rate.

    All statuses count (as in the reference); pass ``statuses`` to restrict.
    ``products`` supplies name/category (columns ``product_id, name, category``).
    """
    o = orders.filter(F.col("status").isin(list(statuses))) if statuses else orders
    # Group on the month's first day (a 4-byte date) and format the period text
    # once per output row, not once per order line; the mapping is one to one.
    perf = (o.withColumn("_month", month_start("created_at"))
             .groupBy("product_id", "_month")
             .agg(F.sum("quantity").cast("int").alias("units_sold"),
                  F.sum("total_amount").cast(SUM_MONEY).alias("rev"),
                  F.sum("unit_price").cast(SUM_MONEY).alias("price_sum"),
                  F.count("unit_price").alias("price_n"),
                  F.count_if(F.col("status") == "refunded").alias("refunded"),
                  F.count("order_id").alias("n"))
             .select("product_id", period("_month").alias("period"), "units_sold",
                     F.round("rev", 2).alias("revenue"),
                     div_round("price_sum", "price_n", 2).alias("avg_price"),
                     ratio_round("refunded", "n", 4).alias("return_rate")))
    if products is None:
        return perf
    dim = products.select("product_id", F.col("name").alias("product_name"), "category")
    # Dimension enrich: AQE turns this into a broadcast join when the product
    # side's measured size is under the threshold; otherwise it stays a shuffle.
    return perf.join(dim, "product_id", "left")


def customer_totals(orders: DataFrame, exclude_status: str | None = "cancelled") -> DataFrame:
    """A5: per-customer spend, order count and last order time."""
    o = orders.filter(F.col("status") != exclude_status) if exclude_status else orders
    return (o.groupBy("customer_id")
             .agg(F.round(F.sum("total_amount"), 2).cast(SUM_MONEY).alias("total_spent"),
                  F.count("order_id").cast("int").alias("order_count"),
                  F.max("created_at").alias("last_order_at")))


def clv_score(total_spent, order_count, days, cap=CLV_CAP_SEGMENTS, digits=4):
    """``round(least(spent * orders / (days + 1), cap), digits)``; NULL when days = -1."""
    num = (F.col(total_spent).cast("decimal(20,2)")
           * F.col(order_count).cast("decimal(10,0)"))
    den = (F.col(days) + 1).cast("decimal(10,0)")
    q = F.try_divide(num, F.nullif(den, F.lit(0).cast("decimal(10,0)")))
    capped = F.when(q.isNotNull(), F.least(q, F.lit(Decimal(str(cap)))))
    return F.round(capped, digits)


def customer_segments(orders: DataFrame, customers: DataFrame, as_of,
                      thresholds=SEGMENT_THRESHOLDS) -> DataFrame:
    """A6 + J3: totals, recency, CLV, rule segment; customers without orders
    get 0 / 0 / 0 / ``new`` and orders of unknown customers are dropped."""
    agg = customer_totals(orders)
    seg = (agg.withColumn("days_since_last", days_since(as_of, "last_order_at"))
              .withColumn("clv_score", clv_score("total_spent", "order_count",
                                                 "days_since_last"))
              .withColumn("segment", customer_segment("total_spent", "days_since_last",
                                                      "order_count", thresholds)))
    ids = customers.select("customer_id")
    out = ids.join(seg, "customer_id", "left")
    return (out.select(
        "customer_id",
        F.coalesce("total_spent", F.lit(0).cast(SUM_MONEY)).alias("total_spent"),
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        "last_order_at", "days_since_last",
        F.coalesce("clv_score", F.lit(0).cast("decimal(38,4)")).alias("clv_score"),
        F.coalesce("segment", F.lit("new")).alias("segment")))
