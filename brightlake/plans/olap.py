"""OLAP copy (S9, J4) and collapsed reads.

The copy is an append-only version log: each sync appends rows stamped with
``inserted_at``; readers first collapse to the latest version per key, so a
re-sync never double counts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightlake.functions.dates import as_ts_lit
from brightlake.operators.dedupe import latest_by

EPOCH_DEFAULT = _dt.datetime(2000, 1, 1)

DAILY_KEYS = ["date"]
PRODUCT_KEYS = ["period", "product_id"]
CUSTOMER_KEYS = ["customer_id"]


def daily_copy(daily: DataFrame, inserted_at) -> DataFrame:
    return daily.select(
        "date",
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce("total_revenue", F.lit(0)).cast("double").alias("total_revenue"),
        F.coalesce("avg_order", F.lit(0)).cast("double").alias("avg_order"),
        F.coalesce("unique_customers", F.lit(0)).cast("bigint").alias("unique_customers"),
        F.coalesce("top_category", F.lit("")).alias("top_category"),
        as_ts_lit(inserted_at).alias("inserted_at"))


def product_copy(perf: DataFrame, inserted_at) -> DataFrame:
    """Columns are mapped by name (the average price is ``avg_price``, not a rating)."""
    return perf.select(
        F.coalesce("period", F.lit("")).alias("period"),
        F.coalesce(F.col("product_id").cast("string"), F.lit("")).alias("product_id"),
        F.coalesce("product_name", F.lit("")).alias("product_name"),
        F.coalesce("category", F.lit("")).alias("category"),
        F.coalesce("revenue", F.lit(0)).cast("double").alias("total_revenue"),
        F.coalesce("units_sold", F.lit(0)).cast("bigint").alias("units_sold"),
        F.coalesce("avg_price", F.lit(0)).cast("double").alias("avg_price"),
        as_ts_lit(inserted_at).alias("inserted_at"))


def customer_copy(segments: DataFrame, features: DataFrame, inserted_at) -> DataFrame:
    """Segments (numeric id) left-joined to features (text id) on the text form;
    missing churn is 0, CLV comes from the segments' ``clv_score``."""
    f = features.select(F.col("customer_id").cast("string").alias("_fid"),
                        F.col("churn_probability").alias("_churn"))
    s = segments.withColumn("_sid", F.col("customer_id").cast("string"))
    j = s.join(f, s["_sid"] == f["_fid"], "left")
    return j.select(
        F.coalesce("_sid", F.lit("")).alias("customer_id"),
        F.coalesce("segment", F.lit("unknown")).alias("segment"),
        F.coalesce("total_spent", F.lit(0)).cast("double").alias("total_spent"),
        F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce("clv_score", F.lit(0)).cast("double").alias("clv_score"),
        F.coalesce("_churn", F.lit(0)).cast("double").alias("churn_probability"),
        F.coalesce("last_order_at", F.lit(EPOCH_DEFAULT).cast("timestamp_ntz"))
         .alias("last_order_at"),
        as_ts_lit(inserted_at).alias("inserted_at"))


def collapse(log: DataFrame, keys) -> DataFrame:
    """Latest ``inserted_at`` per key (ties: greatest full row)."""
    return latest_by(log, keys, ["inserted_at"])
