"""Served queries (Q1-Q15) and dashboard calculations (A14-A23) as DataFrames.

Every limit here is the feature (a top-k report); every top-k carries a key
tie-break so results are deterministic. ``orderBy(...).limit(k)`` plans as
``TakeOrderedAndProject``: each task keeps k rows, no global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightlake.functions.money import div_round, ratio_round
from brightlake.functions.rules import RISK_HIGH, RISK_MEDIUM, risk_level
from brightlake.operators.cleaning import last_n_days, point_lookup
from brightlake.plans.models import top_products


def summary(daily: DataFrame, segments: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Q1 = A14 + A15 in one global aggregate over a tagged union (no join)."""
    recent = last_n_days(daily, "date", as_of, days).select(
        "total_revenue", "total_orders", "avg_order", "unique_customers",
        F.lit(None).cast("string").alias("segment"))
    segs = segments.select(
        F.lit(None).cast(daily.schema["total_revenue"].dataType).alias("total_revenue"),
        F.lit(None).cast("bigint").alias("total_orders"),
        F.lit(None).cast(daily.schema["avg_order"].dataType).alias("avg_order"),
        F.lit(None).cast("bigint").alias("unique_customers"), "segment")
    u = recent.unionByName(segs)
    return u.agg(
        F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("total_revenue"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(div_round(F.sum("avg_order"), F.count("avg_order"), 4),
                   F.lit(0)).alias("avg_order_value"),
        F.coalesce(F.max("unique_customers"), F.lit(0)).alias("unique_customers"),
        F.count_if(F.col("segment") == "vip").alias("vip_customers"),
        F.count_if(F.col("segment") == "at_risk").alias("at_risk_customers"))


def recent_daily_sales(daily: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Q2: newest day first."""
    return last_n_days(daily, "date", as_of, days).orderBy(F.col("date").desc())


def latest_trends(trends: DataFrame, limit: int = 90) -> DataFrame:
    """Q3: newest ``limit`` days; a missing rolling value falls back to the day's revenue."""
    return (trends.select(
        "date", "total_revenue",
        F.coalesce("revenue_7d_avg", "total_revenue").alias("revenue_7d_avg"),
        F.coalesce("revenue_7d_sum", "total_revenue").alias("revenue_7d_sum"),
        "mom_growth_pct")
        .orderBy(F.col("date").desc()).limit(limit))


def top_products_of_period(perf: DataFrame, limit: int = 10,
                           period: str | None = None) -> DataFrame:
    """Q4: a period's top products by revenue rank; default period = the latest.

    Ranks are within a period, so the period is chosen on ``perf`` first
    (scalar subquery) and only that period is ranked. Where the order lines are
    at hand, ``latest_month`` names the period without building ``perf`` first.
    """
    if period is None:
        latest = perf.select(F.max("period")).scalar()
        chosen = perf.where(F.col("period") == latest)
    else:
        chosen = perf.where(F.col("period") == F.lit(period))
    return (top_products(chosen)
            .select("product_id", F.coalesce("product_name", F.lit("Unknown")).alias("product_name"),
                    F.coalesce("category", F.lit("Unknown")).alias("category"), "period", "units_sold",
                    "revenue", "avg_price", "return_rate_pct", "revenue_rank")
            .orderBy(F.col("revenue_rank").asc(), F.col("product_id").asc())
            .limit(limit))


def latest_month(orders: DataFrame):
    """First day of the newest month with an order line (None without any)."""
    newest = orders.agg(F.max("order_date").alias("d")).first()["d"]
    return newest.replace(day=1) if newest else None


def segment_summary(segments: DataFrame) -> DataFrame:
    """Q5 = A16."""
    return (segments.groupBy("segment").agg(
        F.count(F.lit(1)).alias("count"),
        div_round(F.sum("total_spent"), F.count("total_spent"), 2).alias("avg_spent"),
        ratio_round(F.sum("order_count"), F.count("order_count"), 1).alias("avg_orders"),
        div_round(F.sum("clv_score"), F.count("clv_score"), 4).alias("avg_clv"))
        .orderBy(F.col("avg_spent").desc(), F.col("segment")))


def customer_ltv_lookup(ltv: DataFrame, customer_id) -> DataFrame:
    """Q6 = W11 + F18."""
    return point_lookup(ltv, "customer_id", customer_id).select(
        "customer_id", "segment", "rfm_segment", "rfm_score", "total_spent",
        "avg_order_value", "order_count", "last_order_at", "clv_score")


def recent_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    """Q7."""
    return runs.orderBy(F.col("started_at").desc(), F.col("pipeline_name")).limit(limit)


def catalog_listing(catalog: DataFrame) -> DataFrame:
    """Q8 = S14 + O3."""
    return catalog.orderBy("layer", "table_name")


def recent_dq_results(results: DataFrame, limit: int = 100) -> DataFrame:
    """Q9."""
    return (results.select("table_name", "layer", "check_name", "status", "rows_tested",
                           "rows_failed", "run_at")
                   .orderBy(F.col("run_at").desc(), "table_name", "check_name").limit(limit))


def ml_summary(features: DataFrame) -> DataFrame:
    """Q10 = A17: risk buckets (0.4 and 0.7 are both medium here), averages rounded."""
    p = F.col("churn_probability")
    return features.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(p > RISK_HIGH).alias("high_risk_count"),
        F.count_if(p.between(RISK_MEDIUM, RISK_HIGH)).alias("medium_risk_count"),
        F.count_if(p < RISK_MEDIUM).alias("low_risk_count"),
        div_round(F.sum(p), F.count(p), 4).alias("avg_churn_probability"),
        div_round(F.sum("clv_score"), F.count("clv_score"), 2).alias("avg_clv_score"))


def churn_risk(features: DataFrame, min_probability: float = 0.5, limit: int = 20) -> DataFrame:
    """Q11."""
    return (features.filter(F.col("churn_probability") > min_probability)
            .select("customer_id", "churn_probability", "clv_score", "days_since_last",
                    "preferred_category")
            .orderBy(F.col("churn_probability").desc(), F.col("customer_id")).limit(limit))


def customer_ml(features: DataFrame, customer_id) -> DataFrame:
    """Q12: one customer's features plus a risk level (> 0.7 high, > 0.4 medium)."""
    return point_lookup(features, "customer_id", customer_id).select(
        "customer_id", "order_count_30d", "avg_basket_size", "churn_probability", "clv_score",
        "preferred_category", "days_since_last", "computed_at",
        risk_level("churn_probability").alias("risk_level"))


def olap_stats(daily_copy: DataFrame) -> DataFrame:
    """Q13 = A18 over the collapsed copy."""
    return daily_copy.agg(F.count(F.lit(1)).alias("total_rows"),
                          F.sum(F.col("total_revenue").cast("decimal(18,2)")).alias("total_revenue"),
                          F.max("date").alias("latest_date"))


def olap_top_products(product_copy: DataFrame, limit: int = 10) -> DataFrame:
    """Q14 = A19."""
    return (product_copy.groupBy("product_name", "category").agg(
        F.sum(F.col("total_revenue").cast("decimal(18,2)")).alias("revenue"),
        F.sum("units_sold").alias("units"))
        .orderBy(F.col("revenue").desc(), "product_name", "category").limit(limit))


def olap_churn_stats(customer_copy: DataFrame) -> DataFrame:
    """Q15: countIf buckets and averages (rounded to 6 dp for exact comparison)."""
    p = F.col("churn_probability").cast("decimal(10,4)")
    clv = F.col("clv_score").cast("decimal(24,4)")
    return customer_copy.agg(
        F.count_if(p > RISK_HIGH).alias("high_risk"),
        F.count_if(p.between(RISK_MEDIUM, RISK_HIGH)).alias("medium_risk"),
        F.count_if(p < RISK_MEDIUM).alias("low_risk"),
        div_round(F.sum(p), F.count(p), 6).alias("avg_churn"),
        div_round(F.sum(clv), F.count(clv), 6).alias("avg_clv"))


def category_rollup(top: DataFrame) -> DataFrame:
    """Revenue and units by category of the current top-N."""
    return top.groupBy("category").agg(F.sum("revenue").alias("revenue"),
                                       F.sum("units_sold").alias("units"))


def run_status_counts(runs: DataFrame) -> DataFrame:
    """A21."""
    s = F.col("status")
    return runs.agg(F.count_if(s == "success").alias("success"),
                    F.count_if(s == "failed").alias("failed"),
                    F.count_if(s == "running").alias("running"))


def feature_run_summary(features: DataFrame) -> DataFrame:
    """A22 + A23: customers, average churn and CLV, high-risk count."""
    p = F.col("churn_probability")
    return features.agg(F.count(F.lit(1)).alias("customers"),
                        div_round(F.sum(p), F.count(p), 4).alias("avg_churn"),
                        div_round(F.sum("clv_score"), F.count("clv_score"), 2).alias("avg_clv"),
                        F.count_if(p > RISK_HIGH).alias("high_risk"))

