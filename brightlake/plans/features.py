"""Customer and product feature vectors (A8-A13), churn stand-in and F16 defaults."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightlake.functions.dates import as_ts_lit, days_since
from brightlake.functions.money import SUM_MONEY, div_round, ratio_round
from brightlake.functions.rules import CLV_CAP_FEATURES, price_tier
from brightlake.operators.topk import arg_max_per_group
from brightlake.plans.gold import clv_score
from brightlake.session import written
from brightlake.sources.sinks import truncate_insert

WINDOWS = (7, 30, 90)
#: Cells of one task of ``training_features``, about.
CELL_ROWS = 50_000


def preferred_category(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """Most frequent category per key; tie -> smallest category.

    (key, category) counts are a partial aggregate; the arg-max is a second
    small aggregate. Never an arbitrary ``first``.
    """
    counts = orders.filter(F.col("category").isNotNull()).groupBy(key, "category").agg(
        F.count(F.lit(1)).alias("n"))
    return arg_max_per_group(counts, [key], "category", "n", tie_break="category",
                             alias="preferred_category")


def customer_features(orders: DataFrame, as_of, exclude_status: str = "cancelled") -> DataFrame:
    """A12 (+ A11) in one scan of the order lines, with no join.

    Every feature is decomposable, so a (customer, category) cell aggregate
    (map-side combined) is rolled up per customer. The same cells give the
    preferred category: the one with most rows, ties -> smallest category.
    ``datediff(as_of, order_date) <= n`` also counts future-dated orders
    (negative difference), as the feature job does.
    """
    o = orders.filter(F.col("status") != exclude_status)
    age = days_since(as_of, "order_date")
    cells = o.groupBy("customer_id", "category").agg(
        F.max("order_date").alias("_last"),
        *[F.count_if(age <= n).alias(f"_c{n}") for n in WINDOWS],
        F.sum(F.when(age <= 30, F.col("total_amount")).otherwise(F.lit(0))).alias("_spent30"),
        F.sum("total_amount").alias("_spent"),
        F.count("total_amount").alias("_n_amount"),
        F.count_if(F.col("status") == "refunded").alias("_refunded"),
        F.count("order_id").alias("_n"),
        F.count(F.lit(1)).alias("_rows"))
    most = F.when(F.col("category").isNotNull(),
                  F.struct((-F.col("_rows")).alias("o"), F.col("category").alias("t")))
    base = cells.groupBy("customer_id").agg(
        F.max("_last").alias("_last"),
        *[F.sum(f"_c{n}").cast("int").alias(f"order_count_{n}d") for n in WINDOWS],
        F.sum("_spent30").cast(SUM_MONEY).alias("_spent30"),
        F.sum("_spent").cast(SUM_MONEY).alias("_spent"),
        F.sum("_n_amount").alias("_n_amount"),
        F.sum("_refunded").alias("_refunded"),
        F.sum("_n").alias("_n"),
        F.min_by(F.col("category"), most).alias("preferred_category"))
    return _feature_columns(base, as_of)


def _feature_columns(base: DataFrame, as_of) -> DataFrame:
    """The feature vector from a customer's sums."""
    feats = base.withColumn("_as_of", as_ts_lit(as_of)).select(
        "customer_id", "_as_of",
        days_since(F.col("_as_of"), "_last").alias("days_since_last"),
        *[f"order_count_{n}d" for n in WINDOWS],
        F.round("_spent30", 2).alias("total_spent_30d"),
        div_round("_spent", "_n_amount", 2).alias("avg_basket_size"),
        F.round("_spent", 2).alias("total_spent_all"),
        ratio_round("_refunded", "_n", 4).alias("return_rate"),
        "preferred_category")
    feats = feats.withColumn("clv_score", clv_score("total_spent_all", "order_count_30d",
                                                    "days_since_last", CLV_CAP_FEATURES, 2))
    return feats.select("customer_id", "days_since_last",
                        *[f"order_count_{n}d" for n in WINDOWS], "total_spent_30d",
                        "avg_basket_size", "total_spent_all", "return_rate", "clv_score",
                        "preferred_category", F.col("_as_of").alias("computed_at"))


def _slot(day, breaks: list[str], low: int = 0):
    """Number of ``breaks`` (ascending) at or before ``day``, by a search tree of comparisons."""
    if not breaks:
        return F.lit(low)
    mid = len(breaks) // 2
    return (F.when(day < F.lit(breaks[mid]).cast("date"), _slot(day, breaks[:mid], low))
            .otherwise(_slot(day, breaks[mid + 1:], low + mid + 1)))


def training_features(orders: DataFrame, dates, exclude_status: str = "cancelled") -> DataFrame:
    """A8-A12 at many as-of dates in one scan: for each date the ``customer_features`` of the
    order lines before it; customers without one have no row.

    The dates, and the first days of their 7, 30 and 90 days, cut the calendar into slots. One
    map-side aggregate gives (customer, category, slot) cells; a running sum over a customer's
    category (as many rows as slots at most) turns them into prefix sums, and a
    window's sum is the difference of two prefixes. Each prefix is handed to the cuts that lie
    between its slot and the next, so a customer's category has one row for each cut.

    A cell becomes many rows on the way, all within its customer, so the cells are written and
    dealt to tasks by customer, some ``CELL_ROWS`` each: a task's memory does not grow with the
    table, and the three steps after the deal need no other shuffle.
    """
    dates = sorted({str(d)[:10] for d in dates})
    day = _dt.date.fromisoformat
    cuts: dict[str, list[tuple[int, int]]] = {}
    for j, d in enumerate(dates):
        for n in (0, *WINDOWS):
            cuts.setdefault((day(d) - _dt.timedelta(days=n)).isoformat(), []).append((j, n))
    breaks = sorted(cuts)
    o = orders.filter(F.col("status") != exclude_status).filter(
        F.col("order_date") < F.lit(dates[-1]).cast("date"))
    cells = o.groupBy("customer_id", "category", _slot(F.col("order_date"), breaks).alias("_slot")).agg(
        F.max("order_date").alias("_last"), F.sum("total_amount").cast(SUM_MONEY).alias("_spent"),
        F.count("total_amount").alias("_n_amount"),
        F.count_if(F.col("status") == "refunded").alias("_refunded"),
        F.count("order_id").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    cells = written(cells, "training-cells")   # counted from its footers
    cells = cells.repartition(max(1, -(-cells.count() // CELL_ROWS)), "customer_id")
    order = Window.partitionBy("customer_id", "category").orderBy("_slot")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    sums = ["_spent", "_n_amount", "_refunded", "_n", "_rows"]
    prefix = cells.select(
        "customer_id", "category", "_slot", F.max("_last").over(upto).alias("_last"),
        *[F.sum(c).over(upto).alias(c) for c in sums],
        F.lead("_slot", 1, len(breaks)).over(order).alias("_next"))
    asked = F.array(*[F.array(*[F.struct(F.lit(j).alias("j"), F.lit(n).alias("n")) for j, n in cuts[b]])
                      for b in breaks])
    at = (prefix.filter(F.col("_slot") < F.col("_next"))
          .withColumn("_cut", F.explode(F.sequence(F.col("_slot"), F.col("_next") - 1)))
          .withColumn("_ask", F.explode(F.element_at(asked, F.col("_cut") + 1))))
    here = F.col("_ask.n") == 0
    known = at.groupBy("customer_id", "category", F.col("_ask.j").alias("_j")).agg(
        F.max(F.when(here, F.col("_last"))).alias("_last"),
        *[F.sum(F.when(here, F.col(c))).alias(c) for c in sums],
        *[F.coalesce(F.sum(F.when(F.col("_ask.n") == n, F.col("_rows"))), F.lit(0)).alias(f"_b{n}")
          for n in WINDOWS],
        F.coalesce(F.sum(F.when(F.col("_ask.n") == 30, F.col("_spent"))), F.lit(0)).alias("_spent_b30"))
    most = F.when(F.col("category").isNotNull(),
                  F.struct((-F.col("_rows")).alias("o"), F.col("category").alias("t")))
    base = known.groupBy("customer_id", "_j").agg(
        F.max("_last").alias("_last"),
        *[F.sum(F.col("_rows") - F.col(f"_b{n}")).cast("int").alias(f"order_count_{n}d") for n in WINDOWS],
        F.sum(F.coalesce("_spent", F.lit(0)) - F.col("_spent_b30")).cast(SUM_MONEY).alias("_spent30"),
        F.sum("_spent").cast(SUM_MONEY).alias("_spent"),
        F.sum("_n_amount").alias("_n_amount"), F.sum("_refunded").alias("_refunded"),
        F.sum("_n").alias("_n"), F.min_by(F.col("category"), most).alias("preferred_category"))
    when = F.element_at(F.array(*[F.lit(d).cast("timestamp_ntz") for d in dates]), F.col("_j") + 1)
    return _feature_columns(base, when)


def churn_stand_in(days_col: str = "days_since_last", half_life_days: int = 180):
    """Deterministic churn probability ``d / (d + h)`` (4 dp) for exact checks.

    Used where a served query needs a probability without training a model;
    the MLlib score from ``plans.ml`` replaces it in production runs.
    """
    d = F.greatest(F.col(days_col), F.lit(0))
    return ratio_round(d, d + half_life_days, 4)


def with_feature_defaults(features: DataFrame) -> DataFrame:
    """F16 on save: counts/amounts 0, ``days_since_last`` 999, category ``unknown``.

    Only NULL is missing: a real 0 days stays 0.
    """
    # The defaults of the saved columns.
    defaults = {"order_count_7d": 0, "order_count_30d": 0, "order_count_90d": 0,
                "total_spent_30d": 0, "avg_basket_size": 0, "return_rate": 0,
                "days_since_last": 999, "clv_score": 0, "churn_probability": 0,
                "preferred_category": "unknown"}
    return features.select(*[
        F.coalesce(F.col(c), F.lit(defaults[c]).cast(features.schema[c].dataType)).alias(c)
        if c in defaults else F.col(c) for c in features.columns])


def product_features(orders: DataFrame, products: DataFrame, as_of,
                     tiers=(50, 200, 500)) -> DataFrame:
    """Units 7/30 d, revenue 30 d, return rate, stock, price tier, category."""
    age = days_since(as_of, "order_date")
    agg = orders.groupBy("product_id").agg(
        F.sum(F.when(age <= 7, F.col("quantity")).otherwise(F.lit(0))).alias("units_sold_7d"),
        F.sum(F.when(age <= 30, F.col("quantity")).otherwise(F.lit(0))).alias("units_sold_30d"),
        F.sum(F.when(age <= 30, F.col("total_amount")).otherwise(F.lit(0)))
         .cast(SUM_MONEY).alias("revenue_30d"),
        F.count_if(F.col("status") == "refunded").alias("_refunded"),
        F.count("order_id").alias("_n"))
    dim = products.select("product_id", "category", F.col("stock").alias("stock_level"),
                          F.col("rating").alias("avg_rating"),
                          price_tier("base_price", tiers).alias("price_tier"))
    out = dim.join(agg, "product_id", "left")
    return out.select(
        "product_id",
        F.coalesce("units_sold_7d", F.lit(0)).cast("bigint").alias("units_sold_7d"),
        F.coalesce("units_sold_30d", F.lit(0)).cast("bigint").alias("units_sold_30d"),
        F.coalesce("revenue_30d", F.lit(0).cast(SUM_MONEY)).alias("revenue_30d"),
        "avg_rating",
        ratio_round("_refunded", "_n", 4).alias("return_rate"),
        "stock_level", "price_tier", "category",
        as_ts_lit(as_of).alias("event_timestamp"))


def save_scored_features(scored: DataFrame, path: str) -> str:
    """The serving table after a scoring run: truncated, then inserted.

    Every column is that of the run (with the F16 defaults), and customers the
    run does not know are gone. Ids are text there.
    """
    fresh = with_feature_defaults(scored).withColumn("customer_id",
                                                     F.col("customer_id").cast("string"))
    return truncate_insert(fresh, path)
