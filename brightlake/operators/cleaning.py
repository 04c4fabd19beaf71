"""Bronze -> silver cleaning (F1-F19) as pure, deterministic DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from brightlake.functions.dates import as_ts_lit, days_since, parse_ts
from brightlake.functions.money import MONEY
from brightlake.functions.rules import PRICE_TIERS, price_tier
from brightlake.operators.dedupe import first_by_key, first_of_ids, latest_by


def parse_if_text(df: DataFrame, col: str) -> DataFrame:
    """ISO-8601 text -> timestamp; unparseable text -> NULL (never raises)."""
    if isinstance(df.schema[col].dataType, StringType):
        return df.withColumn(col, parse_ts(col))
    return df


def norm_text(c) -> Column:
    """``lower(trim(x))``."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """F4."""
    return df.na.drop(subset=list(keys))


LANDING_COLUMNS = ("_landed_at", "_landed_file", "_landed_row")


def clean_orders(raw: DataFrame, as_of, key: str = "order_id", dedupe_order=None) -> DataFrame:
    """parse, keep the first landed row of each id, then ``clean_order_rows``.

    Landing order is given by the ``_landed_*`` columns of a landing scan; a
    table without them is ordered by ``created_at``, an unknown time last.
    """
    landed = [c for c in LANDING_COLUMNS if c in raw.columns]
    df = parse_if_text(raw, "created_at")
    df = first_of_ids(df, key, list(dedupe_order or landed or ["created_at"]))
    return clean_order_rows(df.drop(*landed), as_of, key)


def clean_order_rows(df: DataFrame, as_of, key: str = "order_id") -> DataFrame:
    """The per-row part of the order cleaning, shared by batch and stream (F4-F9):
    drop null keys, positive-value filters, normalise status, net revenue, flags, dates.

    ``revenue_net = round(total_amount * (1 - discount), 2)`` discounts a total
    that already includes the discount; the formula is kept as the pipeline
    defines it.
    """
    df = drop_null_keys(df, [key, "customer_id", "product_id"])
    df = df.filter((F.col("unit_price") > 0) & (F.col("quantity") > 0)
                   & (F.col("total_amount") > 0))
    total = F.col("total_amount").cast(MONEY)
    disc = F.col("discount").cast("decimal(6,4)")
    return (df.withColumn("status", norm_text("status"))
              .withColumn("revenue_net", F.round(total * (F.lit(1) - disc), 2))
              .withColumn("is_refunded", F.col("status") == "refunded")
              .withColumn("order_date", F.to_date("created_at"))
              .withColumn("_ingested_at", as_ts_lit(as_of)))


def clean_customers(raw: DataFrame, as_of, snapshot_col: str | None = "_snapshot",
                    require_email: bool = True) -> DataFrame:
    """newest snapshot wins per customer, drop null keys, normalise
    email/segment, ``days_since_joined`` from the explicit ``as_of``."""
    df = parse_if_text(raw, "joined_at") if "joined_at" in raw.columns else raw
    if snapshot_col and snapshot_col in df.columns:
        df = latest_by(df, ["customer_id"], [snapshot_col])
    else:
        df = first_by_key(df, ["customer_id"])
    keys = ["customer_id"] + (["email"] if require_email and "email" in df.columns else [])
    df = drop_null_keys(df, keys)
    for c in ("email", "segment"):
        if c in df.columns:
            df = df.withColumn(c, norm_text(c))
    joined = days_since(as_of, "joined_at") if "joined_at" in df.columns else F.lit(None)
    return (df.withColumn("days_since_joined", joined.cast("int"))
              .withColumn("_ingested_at", as_ts_lit(as_of)))


def clean_products(raw: DataFrame, as_of, snapshot_col: str | None = "_snapshot",
                   tiers=PRICE_TIERS) -> DataFrame:
    """newest snapshot wins, drop null id/name, positive price, price tier."""
    df = raw
    if snapshot_col and snapshot_col in df.columns:
        df = latest_by(df, ["product_id"], [snapshot_col])
    else:
        df = first_by_key(df, ["product_id"])
    df = drop_null_keys(df, ["product_id", "name"]).filter(F.col("base_price") > 0)
    return (df.withColumn("price_tier", price_tier("base_price", tiers))
              .withColumn("_ingested_at", as_ts_lit(as_of)))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace only NULL (a real 0 stays 0) and cast to the default's type."""
    out = []
    for c in df.columns:
        if c in defaults:
            d = defaults[c]
            out.append(F.coalesce(F.col(c), F.lit(d).cast(df.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def last_n_days(df: DataFrame, date_col: str, as_of, days: int) -> DataFrame:
    """``date >= as_of - days``."""
    return df.filter(F.col(date_col) >= F.date_sub(as_ts_lit(as_of).cast("date"), days))


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """F18."""
    return df.filter(F.col(key) == F.lit(value))
