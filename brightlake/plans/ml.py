"""Churn and lifetime-value models on MLlib.

Training stays distributed (no ``toPandas``): features are assembled and
scaled by a ``Pipeline`` fitted on the training split only, the split is a
hash of the customer id (stable across partitionings), and the median used
for the label is exact from a (days -> count) histogram whose size is bounded
by the calendar, not by the number of customers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Feature order of the two models.
CHURN_FEATURES = ["order_count_7d", "order_count_30d", "order_count_90d", "total_spent_30d",
                  "avg_basket_size", "return_rate", "days_since_last", "clv_score"]
LTV_FEATURES = ["order_count_30d", "order_count_90d", "avg_basket_size", "return_rate",
                "days_since_last"]
SEED = 42
TRAIN_BUCKETS = 8  # of 10: an 80/20 split
#: Rows of one partition of a training table, about.
TRAIN_ROWS = 50_000


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """One-row frame with the exact median of an integer column (mean of the two
    middle values for an even count), from a value histogram."""
    hist = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy(col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(col).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    cum = hist.select(col, F.sum("_c").over(w).alias("_cum"),
                      F.sum("_c").over(everything).alias("_n"))
    k1 = F.floor((F.col("_n") + 1) / 2)
    k2 = F.floor(F.col("_n") / 2) + 1
    return cum.agg(((F.min(F.when(F.col("_cum") >= k1, F.col(col)))
                     + F.min(F.when(F.col("_cum") >= k2, F.col(col)))) / 2.0).alias("median"))


def label_median_recency(features: DataFrame, days_col: str = "days_since_last") -> DataFrame:
    """M1: ``churned = days > max(1, int(median(days)))`` (the reference's label).

    The threshold is a scalar subquery over the histogram, not a driver value.
    """
    med = exact_median(features, days_col)
    threshold = med.select(F.greatest(F.lit(1), F.col("median").cast("int"))).scalar()
    return (features.withColumn("churn_threshold", threshold)
                    .withColumn("churned", (F.col(days_col) > F.col("churn_threshold")).cast("int")))


def split_column(key: str = "customer_id") -> F.Column:
    """M3: True for the training split (80 %), from the key's MD5 (any SQL engine has it)."""
    digits = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % 10 < TRAIN_BUCKETS


def numeric(df: DataFrame, cols) -> DataFrame:
    """M2 null fill: missing features are 0, all as double."""
    return df.select(*[c for c in df.columns if c not in cols],
                     *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])


def in_key_order(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by key and sorted inside each partition, so two fits see the same order.

    A fit passes over the rows hundreds of times, a short job each, so the partitions follow
    the rows and not the session's shuffles.
    """
    n = max(1, -(-df.count() // TRAIN_ROWS))
    return df.repartition(n, key).sortWithinPartitions(key)


def train_churn(labelled: DataFrame, max_iter: int = 100, max_depth: int = 4,
                key: str = "customer_id"):
    """M2 + M4 + M6: scaled features -> GBT; returns (model, test AUC).

    Raises where the training rows have one class only.
    """
    data = numeric(labelled, CHURN_FEATURES).withColumn("_train", split_column(key))
    # Boosting makes ~5 passes per tree: keep the (small) training frame cached.
    train = in_key_order(data.filter("_train").select(key, "churned", *CHURN_FEATURES),
                         key).drop(key).persist()
    test = data.filter(~F.col("_train"))
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=CHURN_FEATURES, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        GBTClassifier(labelCol="churned", featuresCol="features", maxIter=max_iter,
                      maxDepth=max_depth, seed=SEED)])
    try:
        if train.select("churned").distinct().count() < 2:
            raise ValueError("the training rows have one class only")
        model = pipe.fit(train)
    finally:
        train.unpersist()
    auc = BinaryClassificationEvaluator(labelCol="churned", rawPredictionCol="rawPrediction",
                                        metricName="areaUnderROC").evaluate(model.transform(test))
    return model, auc


def score_churn(model, features: DataFrame) -> DataFrame:
    """M5: churn probability (4 dp) for every customer."""
    scored = model.transform(numeric(features, CHURN_FEATURES))
    prob = F.round(vector_to_array("probability")[1], 4)
    return scored.select(*features.columns, prob.alias("churn_probability"))


def train_ltv(features: DataFrame, num_trees: int = 100, key: str = "customer_id",
              target: str = "total_spent_all"):
    """M7 + M8: random forest on 5 features; returns (model, test MAE)."""
    data = numeric(features, LTV_FEATURES).withColumn(
        "_y", F.coalesce(F.col(target).cast("double"), F.lit(0.0))).withColumn(
        "_train", split_column(key))
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=LTV_FEATURES, outputCol="features"),
        RandomForestRegressor(labelCol="_y", featuresCol="features", numTrees=num_trees,
                              seed=SEED)])
    model = pipe.fit(in_key_order(data.filter("_train"), key))
    mae = RegressionEvaluator(labelCol="_y", predictionCol="prediction",
                              metricName="mae").evaluate(model.transform(data.filter(~F.col("_train"))))
    return model, mae


def score_ltv(model, features: DataFrame) -> DataFrame:
    """M7: store the prediction (the reference computes it and discards it)."""
    scored = model.transform(numeric(features, LTV_FEATURES))
    return scored.select(*features.columns, F.round("prediction", 2).alias("ltv_prediction"))


def metrics_rows(spark: SparkSession, model_name: str, version: str, metrics: dict,
                 run_id: str, logged_at: _dt.datetime | None = None) -> DataFrame:
    """M9: ``model_metrics`` rows (one per metric)."""
    at = logged_at or _dt.datetime.now()
    return spark.createDataFrame(
        [(model_name, version, k, float(v), run_id, at) for k, v in metrics.items()],
        "model_name string, model_version string, metric_name string, metric_value double, "
        "run_id string, logged_at timestamp_ntz")


def importances(model, names=CHURN_FEATURES) -> dict:
    """M9: feature importances of the fitted tree stage."""
    tree = model.stages[-1]
    return dict(zip(names, tree.featureImportances.toArray().tolist()))


def save_model(model, path: str) -> str:
    """M9: persist a fitted pipeline (``PipelineModel.load(path)`` reads it back)."""
    model.write().overwrite().save(path)
    return path
