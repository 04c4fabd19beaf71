"""Explicit landing schemas (no inference, no schema merge surprises)."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


BRONZE_ORDERS = _s(("order_id", StringType()), ("customer_id", LongType()),
                   ("product_id", LongType()), ("product_name", StringType()),
                   ("category", StringType()), ("unit_price", DoubleType()),
                   ("quantity", LongType()), ("discount", DoubleType()),
                   ("total_amount", DoubleType()), ("country", StringType()),
                   ("status", StringType()), ("payment_method", StringType()),
                   ("created_at", StringType()))

BRONZE_CUSTOMERS = _s(("customer_id", LongType()), ("name", StringType()),
                      ("email", StringType()), ("country", StringType()),
                      ("segment", StringType()), ("joined_at", StringType()))

BRONZE_PRODUCTS = _s(("product_id", LongType()), ("name", StringType()),
                     ("category", StringType()), ("base_price", DoubleType()),
                     ("stock", LongType()), ("rating", DoubleType()),
                     ("review_count", LongType()))
