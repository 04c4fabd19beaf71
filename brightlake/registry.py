"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` over the driver tables.

Each query reads whole tables (no id subsets, caps or samples) and returns
the same columns as its oracle SQL in ``brightlake.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightlake.operators import asof, cleaning, distinct, quality
from brightlake.operators.dedupe import latest_by
from brightlake.operators.ntile import distributed_ntile
from brightlake.operators.topk import top_k_per_group
from brightlake.operators.upsert import upsert, upsert_files
from brightlake.plans import features, gold, jobs, ml, models, olap, ops, serving
from brightlake.session import move_path, path_exists, scratch_path, written
from brightlake.sources import adapter, landing, sinks
from brightlake.streaming import incremental
from brightlake.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def money_out(df: DataFrame, *cols: str) -> DataFrame:
    """Final projection: publish DECIMAL money columns as DOUBLE."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


@register("daily_sales")
def q_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapter.order_lines(spark, sf_dir)
    return money_out(gold.daily_sales(orders), "total_revenue", "avg_order")


SEGMENT_THRESHOLDS = (3000000, 2000000, 180, 1)


def _perf(spark, sf_dir):
    orders = adapter.order_lines(spark, sf_dir, with_product=False)
    return gold.product_performance(orders, adapter.products(spark, sf_dir))


def _segments(spark, sf_dir):
    orders = adapter.order_lines(spark, sf_dir, with_product=False)
    return gold.customer_segments(orders, adapter.customers(spark, sf_dir),
                                  adapter.ORDERS_AS_OF, SEGMENT_THRESHOLDS)


@register("product_performance")
def q_product_performance(spark, sf_dir):
    return money_out(_perf(spark, sf_dir), "revenue", "avg_price", "return_rate")


@register("customer_segments")
def q_customer_segments(spark, sf_dir):
    return money_out(_segments(spark, sf_dir), "total_spent", "clv_score")


@register("revenue_trends")
def q_revenue_trends(spark, sf_dir):
    daily = gold.daily_sales(adapter.order_lines(spark, sf_dir))
    return money_out(models.revenue_trends(daily), "total_revenue", "avg_order",
                     "revenue_7d_avg", "revenue_7d_sum", "mom_growth_pct")


@register("top_products")
def q_top_products(spark, sf_dir):
    return money_out(models.top_products(_perf(spark, sf_dir)), "revenue", "avg_price",
                     "return_rate_pct", "revenue_share_pct")


@register("customer_ltv")
def q_customer_ltv(spark, sf_dir):
    return money_out(models.customer_ltv(_segments(spark, sf_dir)), "total_spent",
                     "avg_order_value", "clv_score")


@register("ntile_distributed")
def q_ntile_distributed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()]
    return distributed_ntile(orders, 10, order, "decile")


@register("top_category_window")
def q_top_category_window(spark, sf_dir):
    o = adapter.order_lines(spark, sf_dir).filter(F.col("status") == "completed")
    by_cat = (o.groupBy(F.col("order_date").alias("date"), "category")
               .agg(F.sum("total_amount").alias("cat_revenue")))
    top = top_k_per_group(by_cat, ["date"], [F.col("cat_revenue").desc_nulls_last(),
                                            F.col("category").asc()], 1)
    return money_out(top.select("date", F.col("category").alias("top_category"),
                                "cat_revenue", "rn"), "cat_revenue")


@register("top_k_products_per_month")
def q_top_k_products_per_month(spark, sf_dir):
    perf = _perf(spark, sf_dir)
    top = top_k_per_group(perf, ["period"], [F.col("revenue").desc_nulls_last(),
                                            F.col("product_id").asc()], 3)
    return money_out(top.select("period", "product_id", "product_name", "revenue", "rn"),
                     "revenue")


PRODUCT_TIERS = (920, 950, 980)  # p_retailprice spans 900-999.90: hits every tier


def _clean_orders(spark, sf_dir):
    return cleaning.clean_orders(adapter.bronze_order_lines(spark, sf_dir), adapter.ORDERS_AS_OF)


def _clean_products(spark, sf_dir):
    return cleaning.clean_products(adapter.products(spark, sf_dir), adapter.ORDERS_AS_OF,
                                   tiers=PRODUCT_TIERS)


def _clean_customers(spark, sf_dir):
    return cleaning.clean_customers(adapter.customers(spark, sf_dir), adapter.ORDERS_AS_OF,
                                    require_email=False)


def _dq_orders(spark, sf_dir):
    return quality.run_rules(_clean_orders(spark, sf_dir), "orders", "silver",
                             quality.order_rules(), adapter.ORDERS_AS_OF)


def _dq_products(spark, sf_dir):
    return quality.run_rules(_clean_products(spark, sf_dir), "products", "silver",
                             quality.product_rules(), adapter.ORDERS_AS_OF)


@register("clean_orders")
def q_clean_orders(spark, sf_dir):
    return money_out(_clean_orders(spark, sf_dir), "unit_price", "discount", "total_amount",
                     "revenue_net")


@register("clean_products")
def q_clean_products(spark, sf_dir):
    return money_out(_clean_products(spark, sf_dir), "base_price")


@register("clean_customers")
def q_clean_customers(spark, sf_dir):
    return _clean_customers(spark, sf_dir)


@register("dq_orders")
def q_dq_orders(spark, sf_dir):
    return _dq_orders(spark, sf_dir)


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    results = _dq_orders(spark, sf_dir).unionByName(_dq_products(spark, sf_dir))
    gate = quality.dq_gate(results, adapter.ORDERS_AS_OF, hours=1, layer="silver")
    return gate.withColumn("failed_checks", F.array_join("failed_checks", ","))


@register("dq_pass_rate")
def q_dq_pass_rate(spark, sf_dir):
    results = _dq_orders(spark, sf_dir).unionByName(_dq_products(spark, sf_dir))
    return quality.pass_rate(results)


@register("unique_not_null")
def q_unique_not_null(spark, sf_dir):
    daily = gold.daily_sales(adapter.order_lines(spark, sf_dir))
    trends = models.revenue_trends(daily)
    tops = models.top_products(_perf(spark, sf_dir))
    ltv = models.customer_ltv(_segments(spark, sf_dir))
    return (quality.column_tests(trends, "revenue_trends", unique=["date"],
                                 not_null=["date", "total_revenue", "total_orders"])
            .unionByName(quality.column_tests(tops, "top_products",
                                              not_null=["product_id", "period", "revenue"]))
            .unionByName(quality.column_tests(ltv, "customer_ltv", unique=["customer_id"],
                                              not_null=["customer_id", "rfm_score"])))


# ---- features, point-in-time join, versions, upsert, OLAP copy -------------------

def _features(spark, sf_dir, as_of=adapter.ORDERS_AS_OF, since=None, until=None):
    orders = adapter.order_lines(spark, sf_dir)
    if since:
        orders = orders.filter(F.col("order_date") >= F.lit(since).cast("date"))
    if until:
        orders = orders.filter(F.col("order_date") < F.lit(until).cast("date"))
    return features.customer_features(orders, as_of)


def _scored(spark, sf_dir):
    f = _features(spark, sf_dir).withColumn("churn_probability", features.churn_stand_in())
    return features.with_feature_defaults(f)


FEATURE_MONEY = ("total_spent_30d", "avg_basket_size", "total_spent_all", "return_rate",
                 "clv_score", "churn_probability")


def _purchases(spark, sf_dir):
    ev = adapter.events(spark, sf_dir)
    return ev.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("purchase_ts"), F.col("value").alias("purchase_value"),
        F.col("event_id").alias("purchase_id"))


@register("customer_features")
def q_customer_features(spark, sf_dir):
    return money_out(_features(spark, sf_dir), *FEATURE_MONEY)


TRAINING_DATES = [f"{y}-{m:02d}-01" for y in range(1996, 2002) for m in (1, 4, 7, 10) if (y, m) < (2001, 10)]


@register("training_features")
def q_training_features(spark, sf_dir):
    """A8-A12 as known at the start of each quarter, from one scan of the order lines."""
    out = features.training_features(adapter.order_lines(spark, sf_dir), TRAINING_DATES)
    return money_out(out, *FEATURE_MONEY)


@register("rolling_customers")
def q_rolling_customers(spark, sf_dir):
    """Exact distinct customers of each day and of the 7 and 30 days up to it."""
    orders = adapter.order_lines(spark, sf_dir, with_product=False).filter("status = 'completed'")
    bitmaps = distinct.daily_bitmaps(orders, "order_date", "customer_id")
    return distinct.rolling_distinct(written(bitmaps, "daily-bitmaps"), "order_date", (1, 7, 30), "customers")


@register("product_features")
def q_product_features(spark, sf_dir):
    orders = adapter.order_lines(spark, sf_dir, with_product=False)
    pf = features.product_features(orders, adapter.products(spark, sf_dir),
                                   adapter.ORDERS_AS_OF, PRODUCT_TIERS)
    return money_out(pf, "revenue_30d", "return_rate")


@register("preferred_category")
def q_preferred_category(spark, sf_dir):
    orders = adapter.order_lines(spark, sf_dir).filter(F.col("status") != "cancelled")
    return features.preferred_category(orders)


@register("asof_features")
def q_asof_features(spark, sf_dir):
    ev = adapter.events(spark, sf_dir)
    spine = ev.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    return asof.asof_join(spine, _purchases(spark, sf_dir), "user_id", "ts", "purchase_ts",
                          ["purchase_value"], dt.timedelta(days=1), created="purchase_id",
                          split=7)


@register("asof_features_by_time")
def q_asof_features_by_time(spark, sf_dir):
    """J6 with a timestamp as the ``created`` column, every event as spine row (their roles:
    sign-ups, views and errors are looked up against clicks), and parts that do not divide
    the TTL."""
    ev = adapter.events(spark, sf_dir)
    made = (F.date_trunc("day", "ts").cast("timestamp_ntz")
            + F.make_interval(secs=F.col("event_id") % 86400))
    clicks = ev.filter(F.col("event_type") == "click").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("click_hour"),
        F.col("event_id").alias("click_id"), made.alias("created_at"))
    return asof.asof_join(ev.select("event_id", "event_type", "user_id", "ts"), clicks, "user_id",
                          "ts", "click_hour", ["click_id", "created_at"], dt.timedelta(hours=100),
                          created="created_at", split=7)


@register("online_features")
def q_online_features(spark, sf_dir):
    return asof.online_features(_purchases(spark, sf_dir), "user_id", "purchase_ts",
                                adapter.EVENTS_AS_OF, dt.timedelta(days=7),
                                created="purchase_id")


@register("latest_version")
def q_latest_version(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return latest_by(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


UPSERT_COLS = ["customer_id", "order_count_30d", "total_spent_30d", "clv_score", "computed_at"]


@register("upsert_merge")
def q_upsert_merge(spark, sf_dir):
    """Features known at the start of 1998, upserted with those of all lines since then."""
    target = _features(spark, sf_dir, "1998-01-01", until="1998-01-01").select(*UPSERT_COLS)
    source = _features(spark, sf_dir, adapter.ORDERS_AS_OF, since="1998-01-01").select(*UPSERT_COLS)
    merged = upsert(target, source, ["customer_id"], ["clv_score", "computed_at"])
    return money_out(merged, "total_spent_30d", "clv_score")


@register("save_scored_features")
def q_save_scored_features(spark, sf_dir):
    """M10 twice: over the lines before 1998, then over all since, and nothing of the first stays."""
    path = scratch_path(spark, "scored-features")
    for as_of, since in (("1998-01-01", None), (adapter.ORDERS_AS_OF, "1998-01-01")):
        scored = _features(spark, sf_dir, as_of, since=since, until=None if since else as_of)
        features.save_scored_features(
            scored.withColumn("churn_probability", features.churn_stand_in()), path)
    return money_out(spark.read.parquet(path), *FEATURE_MONEY)


def _two_syncs(copy_fn, *args):
    """The copy appended twice (a re-sync): one plan, stamped with two ``inserted_at``.

    Both branches share one subtree, so Spark computes it once (reused exchanges).
    """
    first = copy_fn(*args, "2001-07-31 00:00:00")
    second = first.withColumn("inserted_at", F.lit("2001-08-01 00:00:00").cast("timestamp_ntz"))
    return first.unionByName(second)


@register("olap_copy")
def q_olap_copy(spark, sf_dir):
    log = _two_syncs(olap.customer_copy, _segments(spark, sf_dir), _scored(spark, sf_dir))
    return olap.collapse(log, olap.CUSTOMER_KEYS)


# ---- served queries ----------------------------------------------------------------

def _daily(spark, sf_dir, recent_days: int | None = None):
    """Gold daily sales; with ``recent_days`` only those days are aggregated.

    A day's row depends only on that day's lines, so restricting the order
    lines first gives the same rows and lets the day filter reach the scans
    (the grouping-sets aggregate would stop a filter placed above it).
    """
    orders = adapter.order_lines(spark, sf_dir)
    if recent_days is not None:
        orders = cleaning.last_n_days(orders, "order_date", adapter.ORDERS_AS_OF, recent_days)
    return gold.daily_sales(orders)


@register("q_summary")
def q_summary(spark, sf_dir):
    s = serving.summary(_daily(spark, sf_dir, 30), _segments(spark, sf_dir),
                        adapter.ORDERS_AS_OF, 30)
    return money_out(s, "total_revenue", "avg_order_value")


@register("q_daily_sales")
def q_q_daily_sales(spark, sf_dir):
    d = serving.recent_daily_sales(_daily(spark, sf_dir, 30), adapter.ORDERS_AS_OF, 30)
    return money_out(d, "total_revenue", "avg_order")


@register("q_revenue_trends")
def q_q_revenue_trends(spark, sf_dir):
    t = serving.latest_trends(models.revenue_trends(_daily(spark, sf_dir)), 90)
    return money_out(t, "total_revenue", "revenue_7d_avg", "revenue_7d_sum", "mom_growth_pct")


def _top_latest(spark, sf_dir):
    orders = adapter.order_lines(spark, sf_dir, with_product=False)
    month = serving.latest_month(table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "lineitem").select("l_orderkey"),
        F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .select(F.to_date("o_orderdate").alias("order_date")))
    if month is not None:   # a date filter that reaches the scan of the orders
        orders = orders.filter(F.col("order_date") >= F.lit(month))
    perf = gold.product_performance(orders, adapter.products(spark, sf_dir))
    return serving.top_products_of_period(perf, 10)


@register("q_top_products")
def q_q_top_products(spark, sf_dir):
    return money_out(_top_latest(spark, sf_dir), "revenue", "avg_price", "return_rate_pct")


@register("q_customer_segments")
def q_q_customer_segments(spark, sf_dir):
    return money_out(serving.segment_summary(_segments(spark, sf_dir)), "avg_spent",
                     "avg_orders", "avg_clv")


LOOKUP_CUSTOMER = 42


@register("q_customer_ltv")
def q_q_customer_ltv(spark, sf_dir):
    ltv = models.customer_ltv(_segments(spark, sf_dir))
    return money_out(serving.customer_ltv_lookup(ltv, LOOKUP_CUSTOMER), "total_spent",
                     "avg_order_value", "clv_score")


_medallions: dict[tuple[str, str], str] = {}


def _medallion(spark, sf_dir) -> str:
    """Folder of the medallion run over ``sf_dir``: written once a session, read by many."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _medallions or not path_exists(spark, _medallions[key]):
        base = scratch_path(spark, "medallion")
        jobs.run_medallion(spark, adapter.bronze_order_lines(spark, sf_dir),
                           adapter.customers(spark, sf_dir), adapter.products(spark, sf_dir),
                           base, adapter.ORDERS_AS_OF, SEGMENT_THRESHOLDS, PRODUCT_TIERS,
                           require_email=False)
        _medallions[key] = base
    return _medallions[key]


@register("q_catalog")
def q_catalog(spark, sf_dir):
    """Q8 over the catalog that the medallion jobs wrote (its paths and sizes vary)."""
    cat = spark.read.parquet(f"{_medallion(spark, sf_dir)}/catalog")
    return serving.catalog_listing(cat).select("table_name", "layer", "format", "row_count",
                                               (F.col("size_bytes") > 0).alias("has_bytes"),
                                               "last_updated")


@register("q_dq_results")
def q_dq_results(spark, sf_dir):
    """Q9 over the quality results that the silver jobs stored."""
    return serving.recent_dq_results(
        spark.read.parquet(f"{_medallion(spark, sf_dir)}/dq_results"), 100)


def _raw_dq(spark, sf_dir):
    rules = {**quality.order_rules(max_quantity=49, max_discount=0.05),
             "amount_limit": F.col("total_amount") <= 100000}
    return quality.run_rules(adapter.bronze_order_lines(spark, sf_dir), "orders", "raw", rules,
                             adapter.ORDERS_AS_OF)


@register("dq_raw_orders")
def q_dq_raw_orders(spark, sf_dir):
    """Tighter rules on the landed order lines, before any cleaning."""
    return _raw_dq(spark, sf_dir)


@register("dq_gate_stops")
def q_dq_gate_stops(spark, sf_dir):
    """D7 where it stops: the gate over the raw results."""
    gate = quality.dq_gate(_raw_dq(spark, sf_dir), adapter.ORDERS_AS_OF, hours=1, layer="raw")
    return gate.withColumn("failed_checks", F.array_join("failed_checks", ","))


@register("q_ml_summary")
def q_ml_summary(spark, sf_dir):
    return money_out(serving.ml_summary(_scored(spark, sf_dir)), "avg_churn_probability",
                     "avg_clv_score")


@register("q_churn_risk")
def q_churn_risk(spark, sf_dir):
    return money_out(serving.churn_risk(_scored(spark, sf_dir), 0.5, 20), "churn_probability",
                     "clv_score")


@register("q_customer_ml")
def q_customer_ml(spark, sf_dir):
    return money_out(serving.customer_ml(_scored(spark, sf_dir), LOOKUP_CUSTOMER),
                     "avg_basket_size", "churn_probability", "clv_score")


@register("q_olap_stats")
def q_olap_stats(spark, sf_dir):
    log = _two_syncs(olap.daily_copy, _daily(spark, sf_dir))
    return money_out(serving.olap_stats(olap.collapse(log, olap.DAILY_KEYS)), "total_revenue")


@register("q_olap_top_products")
def q_olap_top_products(spark, sf_dir):
    log = _two_syncs(olap.product_copy, _perf(spark, sf_dir))
    return money_out(serving.olap_top_products(olap.collapse(log, olap.PRODUCT_KEYS)), "revenue")


@register("q_olap_churn_stats")
def q_olap_churn_stats(spark, sf_dir):
    return money_out(serving.olap_churn_stats(q_olap_copy(spark, sf_dir)), "avg_churn", "avg_clv")


@register("category_rollup")
def q_category_rollup(spark, sf_dir):
    return money_out(serving.category_rollup(_top_latest(spark, sf_dir)), "revenue")


@register("feature_summary")
def q_feature_summary(spark, sf_dir):
    return money_out(serving.feature_run_summary(_scored(spark, sf_dir)), "avg_churn", "avg_clv")


# ---- machine learning ----------------------------------------------------------------

@register("churn_label")
def q_churn_label(spark, sf_dir):
    labelled = ml.label_median_recency(_features(spark, sf_dir))
    return labelled.select("customer_id", "days_since_last", "churn_threshold", "churned")


def _labelled(spark, sf_dir):
    return ml.label_median_recency(_features(spark, sf_dir))


@register("ml_split")
def q_ml_split(spark, sf_dir):
    """M1 + M3: customers and churned customers of the training and the test split."""
    return (_labelled(spark, sf_dir).groupBy(ml.split_column().alias("in_training"))
            .agg(F.count(F.lit(1)).alias("customers"), F.sum("churned").alias("churned")))


@register("ml_features")
def q_ml_features(spark, sf_dir):
    """M2: the assembled inputs of the churn model, missing values as 0."""
    return ml.numeric(_labelled(spark, sf_dir), ml.CHURN_FEATURES).select(
        "customer_id", "churned", ml.split_column().alias("in_training"), *ml.CHURN_FEATURES)


@register("churn_scores")
def q_churn_scores(spark, sf_dir):
    # Training, the AUC test and scoring all read the labelled features: write
    # the order aggregation once instead of computing it three times.
    labelled = written(_labelled(spark, sf_dir), "labelled")
    model, _auc = ml.train_churn(labelled)
    return ml.score_churn(model, labelled).select("customer_id", "churned", "churn_probability")


@register("ltv_scores")
def q_ltv_scores(spark, sf_dir):
    feats = written(_features(spark, sf_dir), "features")
    model, _mae = ml.train_ltv(feats)
    return money_out(ml.score_ltv(model, feats).select("customer_id", "total_spent_all",
                                                       "ltv_prediction"), "total_spent_all")


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    """M6, M8, M9: metric rows of the very models that ``churn_scores`` and ``ltv_scores`` score with.

    Counts, the churn rate and the errors of a constant prediction are exact values. What
    training finds has a bound from them: the label is a function of a feature, so the AUC is near
    1; the forest's mean error is below that of predicting the training mean.
    """
    labelled = written(_labelled(spark, sf_dir), "labelled")
    churn, auc = ml.train_churn(labelled)
    _, mae = ml.train_ltv(labelled)
    train = ml.split_column()
    spent = F.coalesce(F.col("total_spent_all").cast("double"), F.lit(0.0))
    mean = F.lit(labelled.filter(train).agg(F.avg(spent)).first()[0] or 0.0)
    known = labelled.agg(F.count(F.lit(1)).alias("customers"), F.count_if(train).alias("training_rows"),
                         F.round(F.avg("churned"), 6).alias("churn_rate"),
                         F.round(F.avg(F.when(~train, F.abs(spent - mean))), 2).alias("mae_of_mean"),
                         ).first().asDict()
    found = {("churn", "auc"): auc, ("ltv", "mae"): mae,
             **{("churn", f"importance_{k}"): v for k, v in ml.importances(churn).items()}}
    rows = None
    for model in ("churn", "ltv"):
        values = {m: v for (owner, m), v in found.items() if owner == model}
        if model == "churn":
            values.update({k: float(v or 0) for k, v in known.items()})
        one = ml.metrics_rows(spark, model, "1", values, "run")
        rows = one if rows is None else rows.unionByName(one)
    name, value = F.col("metric_name"), F.col("metric_value")
    good = (F.when(name == "auc", value.between(0.95, 1))
            .when(name == "mae", (value > 0) & (value < F.lit(float(known["mae_of_mean"] or 0))))
            .when(name.startswith("importance_"), value.between(0, 1)))
    exact = F.when(name.isin(*known), value)
    return rows.select("model_name", "metric_name", exact.alias("exact_value"), good.alias("within_bounds"))


@register("trained_churn_risk")
def q_trained_churn_risk(spark, sf_dir):
    """M5 -> M10 -> Q11: the trained churn probability, saved with the features and served."""
    labelled = written(_labelled(spark, sf_dir), "labelled")
    model, _auc = ml.train_churn(labelled)
    path = scratch_path(spark, "trained-features")
    features.save_scored_features(ml.score_churn(model, labelled).drop("churn_threshold", "churned"), path)
    return money_out(serving.churn_risk(spark.read.parquet(path), 0.5, 20), "churn_probability", "clv_score")


# ---- streaming -----------------------------------------------------------------------

def _run_stream(spark, sf_dir, **options) -> str:
    """Land the order lines as files of three days of delivery and drain each, as it has landed,
    with the incremental stream, one delivery a batch; returns the folder of its tables.

    The deliveries overlap in time: the second brings the oldest lines late, the
    third brings a part of the first again, with another time.
    """
    base = scratch_path(spark, "stream-daily")
    bronze = adapter.bronze_order_lines(spark, sf_dir)
    old = F.coalesce(F.col("created_at") < "1997-01-01", F.lit(False))
    again = F.col("order_id").endswith("-1")
    sent = bronze.withColumn("delivery", F.explode(F.array_compact(
        F.array(F.when(old, 1).otherwise(0), F.when(again, 2)))))
    late = F.when(F.col("delivery") == 2, "2002-01-01T00:00:00").otherwise(F.col("created_at"))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # All lines are computed, dealt and sorted once for all deliveries. All rows of an id land in
    # one file of a delivery, in the order of their times, equal times in that of the other columns.
    (sent.withColumn("created_at", late).repartition(files, "order_id")
     .sortWithinPartitions("delivery", "order_id", "created_at", *bronze.columns)
     .write.partitionBy("delivery").parquet(f"{base}/sent"))
    for i in range(3):
        part = f"{base}/landing/delivery={i}"
        if path_exists(spark, f"{base}/sent/delivery={i}"):
            move_path(spark, f"{base}/sent/delivery={i}", part)
        else:   # a delivery without rows is one as well
            bronze.limit(0).write.parquet(part)
        incremental.run_incremental(spark, f"{base}/landing", bronze.schema, f"{base}/ckpt",
                                    f"{base}/silver", f"{base}/gold", adapter.ORDERS_AS_OF,
                                    max_files_per_trigger=files,
                                    **{k: f"{base}/{v}" if k.endswith("_path") else v for k, v in options.items()})
    return base


@register("stream_daily")
def q_stream_daily(spark, sf_dir):
    """T1 + T2: gold daily sales after three overlapping deliveries."""
    daily = spark.read.parquet(f"{_run_stream(spark, sf_dir)}/gold").drop("month")
    return money_out(daily.select("date", "total_orders", "total_revenue", "avg_order",
                                  "unique_customers", "top_category"),
                     "total_revenue", "avg_order")


@register("stream_quality")
def q_stream_quality(spark, sf_dir):
    """D1 + S13 on the stream: quality results (tighter rules) and run-log rows of each batch, as
    the writes themselves counted them."""
    base = _run_stream(spark, sf_dir, dq_path="dq", runs_path="runs",
                       rules=quality.order_rules(max_quantity=49, max_discount=0.05))
    dq = spark.read.parquet(f"{base}/dq").select(
        F.col("_batch").cast("long").alias("batch"), "check_name", "status", "rows_tested", "rows_failed")
    runs = spark.read.parquet(f"{base}/runs").select(
        F.col("_batch").cast("long").alias("batch"), F.lit("run").alias("check_name"), "status",
        F.col("rows_read").alias("rows_tested"), (F.col("rows_read") - F.col("rows_written")).alias("rows_failed"))
    return dq.unionByName(runs)


# ---- landing snapshots, storage, retention, compaction ----------------------------------

@register("landed_generations")
def q_landed_generations(spark, sf_dir):
    """S1 with merged schemas: order lines landed in three generations. The first has amounts
    as text (some of it no number), narrow quantities and no discount, the second narrow
    quantities, the third a column that is not declared."""
    root = scratch_path(spark, "landed-generations")
    lines = adapter.order_lines(spark, sf_dir, with_product=False).select(
        "order_id", "customer_id", "quantity", "discount", "total_amount", "created_at")
    narrow = lines.withColumn("quantity", F.col("quantity").cast("int"))
    early, middle = F.col("created_at") < "1997-01-01", F.col("created_at") < "1999-01-01"
    amount = F.when(F.col("quantity") > 45, F.lit("n/a")).otherwise(F.col("total_amount").cast("string"))
    (narrow.filter(early).withColumn("total_amount", amount).drop("discount")
     .write.parquet(f"{root}/generation=1"))
    narrow.filter(~early & middle).write.parquet(f"{root}/generation=2")
    lines.filter(~middle).withColumn("channel", F.lit("web")).write.parquet(f"{root}/generation=3")
    return money_out(landing.read_generations(spark, root, lines.schema), "discount", "total_amount")


SNAPSHOT_DATES = ("2001-06-01", "2001-07-01", "2001-08-01")


def _daily_snapshots(spark, sf_dir):
    """Write daily sales as known on each snapshot date (orders before it) as dated files."""
    base = scratch_path(spark, "daily-snapshots")
    orders = adapter.order_lines(spark, sf_dir)
    for d in SNAPSHOT_DATES:
        known = orders.filter(F.col("order_date") < F.lit(d).cast("date"))
        gold.daily_sales(known).write.parquet(f"{base}/snapshot_{d.replace('-', '')}.parquet")
    return base


@register("snapshot_as_of")
def q_snapshot_as_of(spark, sf_dir):
    daily = landing.read_as_of(spark, _daily_snapshots(spark, sf_dir), "2001-07-15")
    return money_out(daily, "total_revenue", "avg_order")


@register("snapshot_list")
def q_snapshot_list(spark, sf_dir):
    return landing.list_snapshots(spark, _daily_snapshots(spark, sf_dir))


@register("storage_stats")
def q_storage_stats(spark, sf_dir):
    """S15 for the order tables: rows by reading them, files and bytes from their listing
    (which vary with the folder, so only whether there are any is returned)."""
    rows = None
    for name in ("customer", "orders", "lineitem", "part"):
        stats = ops.storage_stats(spark, {name: f"{sf_dir.rstrip('/')}/{name}.parquet"})
        counted = table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("row_count"))
        one = counted.crossJoin(stats).select(   # one row with one row
            F.lit(name).alias("table_name"), "row_count", (F.col("files") > 0).alias("has_files"),
            (F.col("size_bytes") > 0).alias("has_bytes"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@register("retention")
def q_retention(spark, sf_dir):
    ev = adapter.events(spark, sf_dir)
    path = scratch_path(spark, "retention-events")
    ev.write.parquet(path)
    n = ops.apply_retention(spark, path, "ts", adapter.EVENTS_AS_OF, 7)
    left = spark.read.parquet(path)
    gone = F.lit(n["kept"] + n["deleted"]) - F.count(F.lit(1))
    return left.agg(F.count(F.lit(1)).alias("kept"), gone.alias("deleted")).unpivot(
        [], ["kept", "deleted"], "part", "row_count").select(
        F.lit("events").alias("table_name"), "part", "row_count")


# ---- file by file: upsert, compaction, retention, lookups ---------------------------------

@register("upsert_files")
def q_upsert_files(spark, sf_dir):
    """S8 by files: orders known before 1998, in a table by year whose keys do not name the
    year, take the prices of all orders since July 1997 (raised by one) and the new orders."""
    orders = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    path = scratch_path(spark, "upsert-files")
    (orders.filter(F.col("o_orderdate") < "1998-01-01")
     .repartitionByRange(4, "o_orderdate").write.partitionBy("order_year").parquet(path))
    source = (orders.filter(F.col("o_orderdate") >= "1997-07-01")
              .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    upsert_files(spark, path, source, ["o_orderkey"], ["o_totalprice"], partition_by=["order_year"])
    return spark.read.parquet(path).select(*orders.columns)


@register("compact_small_files")
def q_compact_small_files(spark, sf_dir):
    """S17 by bins over a table of many small files, by status."""
    path = scratch_path(spark, "compact-small")
    lines = table(spark, sf_dir, "lineitem")
    (lines.repartition(24, "l_orderkey").write.partitionBy("l_returnflag").parquet(path))
    sinks.compact_small_files(spark, path, sort_cols=["l_orderkey", "l_linenumber"])
    return spark.read.parquet(path).select(*lines.columns)


@register("retention_partitions")
def q_retention_partitions(spark, sf_dir):
    """S16 by partitions: events by day, those older than seven days dropped."""
    path = scratch_path(spark, "retention-days")
    (adapter.events(spark, sf_dir).withColumn("day", F.to_date("ts"))
     .hint("rebalance", "day").write.partitionBy("day").parquet(path))
    n = ops.apply_partition_retention(spark, path, "ts", adapter.EVENTS_AS_OF, 7)
    left = spark.read.parquet(path)
    gone = F.lit(n["kept"] + n["deleted"]) - F.count(F.lit(1))
    return left.agg(F.count(F.lit(1)).alias("kept"), gone.alias("deleted")).unpivot(
        [], ["kept", "deleted"], "part", "row_count").select(
        F.lit("events").alias("table_name"), "part", "row_count")


@register("lookup_customer_ltv")
def q_lookup_customer_ltv(spark, sf_dir):
    """Q6 from a stored table: sorted by customer with Bloom filters, one row group read."""
    path = scratch_path(spark, "stored-ltv")
    sinks.write_indexed(models.customer_ltv(_segments(spark, sf_dir)), path, "customer_id")
    found = sinks.lookup(spark, path, "customer_id", LOOKUP_CUSTOMER)
    return money_out(serving.customer_ltv_lookup(found, LOOKUP_CUSTOMER), "total_spent",
                     "avg_order_value", "clv_score")


@register("lookup_customer_ml")
def q_lookup_customer_ml(spark, sf_dir):
    """Q12 from a stored table, as ``lookup_customer_ltv``."""
    path = scratch_path(spark, "stored-features")
    sinks.write_indexed(_scored(spark, sf_dir), path, "customer_id")
    found = sinks.lookup(spark, path, "customer_id", LOOKUP_CUSTOMER)
    return money_out(serving.customer_ml(found, LOOKUP_CUSTOMER), "avg_basket_size",
                     "churn_probability", "clv_score")


@register("compact")
def q_compact(spark, sf_dir):
    path = scratch_path(spark, "compact-lineitem")
    sinks.compact(table(spark, sf_dir, "lineitem"), path, ["l_orderkey", "l_linenumber"])
    return spark.read.parquet(path)


# ---- run log of the medallion jobs --------------------------------------------------------

def _run_log(spark, sf_dir):
    return spark.read.parquet(f"{_medallion(spark, sf_dir)}/run_log")


@register("q_run_history")
def q_run_history(spark, sf_dir):
    """Q7 over the run log of the six medallion jobs (times and durations vary by run)."""
    runs = serving.recent_runs(_run_log(spark, sf_dir), 50)
    return runs.select("pipeline_name", "layer", "status", "rows_read", "rows_written")


@register("run_status")
def q_run_status(spark, sf_dir):
    """A21 over the same run log."""
    return serving.run_status_counts(_run_log(spark, sf_dir))
