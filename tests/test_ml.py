from pyspark.sql import functions as F

from brightlake.plans import ml


def test_exact_median(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "d int")
    assert ml.exact_median(df, "d").first().median == 2.5
    df = spark.createDataFrame([(5,), (1,), (9,)], "d int")
    assert ml.exact_median(df, "d").first().median == 5.0


def test_label_split_and_models(spark):
    feats = spark.range(300).select(
        F.col("id").alias("customer_id"),
        (F.col("id") % 5).cast("int").alias("order_count_7d"),
        (F.col("id") % 11).cast("int").alias("order_count_30d"),
        (F.col("id") % 17).cast("int").alias("order_count_90d"),
        (F.col("id") * 3.5).alias("total_spent_30d"), (F.col("id") % 50 + 1.0).alias("avg_basket_size"),
        F.lit(0.1).alias("return_rate"), (F.col("id") % 200).cast("int").alias("days_since_last"),
        (F.col("id") % 13 * 1.0).alias("clv_score"), (F.col("id") * 10.0).alias("total_spent_all"))
    labelled = ml.label_median_recency(feats)
    r = labelled.agg(F.max("churn_threshold"), F.sum("churned")).first()
    assert r[0] >= 1 and 0 < r[1] < 300
    share = feats.filter(ml.split_column()).count() / 300
    assert 0.65 < share < 0.95
    model, auc = ml.train_churn(labelled, max_iter=5, max_depth=3)
    assert auc > 0.9                                      # the label leaks days_since_last
    scored = ml.score_churn(model, labelled)
    assert scored.filter(F.col("churn_probability").between(0, 1)).count() == 300
    assert set(ml.importances(model)) == set(ml.CHURN_FEATURES)
    lmodel, mae = ml.train_ltv(feats, num_trees=10)
    assert mae >= 0 and ml.score_ltv(lmodel, feats).count() == 300
    rows = ml.metrics_rows(spark, "churn", "1", {"auc": auc}, "run-1")
    assert rows.first().metric_name == "auc"


def test_save_model_and_scored_features(spark, scratch):
    import datetime as dt
    from decimal import Decimal

    from pyspark.ml import PipelineModel

    from brightlake.plans import features
    feats = spark.range(60).select(
        F.col("id").alias("customer_id"), *[(F.col("id") % k).cast("int").alias(c) for k, c in
                                           [(3, "order_count_7d"), (5, "order_count_30d"),
                                            (7, "order_count_90d")]],
        (F.col("id") * 1.5).alias("total_spent_30d"), F.lit(2.0).alias("avg_basket_size"),
        F.lit(0.0).alias("return_rate"), (F.col("id") % 40).cast("int").alias("days_since_last"),
        F.lit(1.0).alias("clv_score"))
    model, _ = ml.train_churn(ml.label_median_recency(feats), max_iter=3, max_depth=2)
    path = ml.save_model(model, f"{scratch}/churn_model")
    assert PipelineModel.load(path).transform(ml.numeric(feats, ml.CHURN_FEATURES)).count() == 60

    cols = "customer_id long, order_count_30d int, days_since_last int, clv_score decimal(18,2), " \
           "churn_probability decimal(10,4), preferred_category string, computed_at timestamp_ntz"
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
    old = spark.createDataFrame([(1, 3, 0, Decimal("5.00"), Decimal("0.1000"), "a", t0)], cols)
    table = f"{scratch}/scored"
    features.save_scored_features(old, table)
    new = spark.createDataFrame([(1, 9, 4, Decimal("7.00"), Decimal("0.9000"), "b", t1),
                                 (2, 1, None, None, Decimal("0.5000"), None, t1)], cols)
    features.save_scored_features(new, table)
    out = {r.customer_id: r for r in spark.read.parquet(table).collect()}
    assert out["1"].order_count_30d == 9 and out["1"].days_since_last == 4     # refreshed
    assert out["1"].churn_probability == Decimal("0.9000") and out["1"].computed_at == t1
    assert out["2"].days_since_last == 999 and out["2"].preferred_category == "unknown"
    features.save_scored_features(new.filter("customer_id = 2"), table)
    assert [r.customer_id for r in spark.read.parquet(table).collect()] == ["2"]   # vanished: gone


def test_one_class_raises_and_fits_repeat(spark):
    import pytest
    feats = spark.range(200).select(
        F.col("id").alias("customer_id"), *[(F.col("id") * k % 13).cast("double").alias(c)
                                           for k, c in enumerate(ml.CHURN_FEATURES, 2)])
    with pytest.raises(ValueError):
        ml.train_churn(feats.withColumn("churned", F.lit(0)), max_iter=2)
    two = feats.withColumn("churned", (F.col("id" if "id" in feats.columns else "customer_id") % 3 == 0)
                           .cast("int"))
    runs = [ml.score_churn(ml.train_churn(two.repartition(n), max_iter=3)[0], two)
            .orderBy("customer_id").collect() for n in (2, 5)]
    assert runs[0] == runs[1]


def test_auc_and_mae_equal_those_of_the_stored_scores(spark):
    """M6 and M8 by their definitions: rank sum of the scores, mean of the absolute errors."""
    from pyspark.ml.functions import vector_to_array
    feats = spark.range(400).select(
        F.col("id").alias("customer_id"), *[((F.col("id") * k * k + 3) % 17).cast("double").alias(c)
                                           for k, c in enumerate(ml.CHURN_FEATURES, 2)],
        (F.col("id") % 23 * 10.0).alias("total_spent_all"))
    data = feats.withColumn("churned", ((F.col("customer_id") * 7 + F.col("days_since_last") * 5) % 11 < 5)
                            .cast("int"))
    model, auc = ml.train_churn(data, max_iter=4, max_depth=3)
    raw = [(r.churned, r.s) for r in model.transform(ml.numeric(data, ml.CHURN_FEATURES)).filter(
        ~ml.split_column()).select("churned", vector_to_array("rawPrediction")[1].alias("s")).collect()]
    good, bad = [s for c, s in raw if c], [s for c, s in raw if not c]
    ranks = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    assert abs(auc - ranks) < 1e-9
    forest, mae = ml.train_ltv(data, num_trees=8)
    errors = [abs(r.prediction - r.total_spent_all) for r in forest.transform(
        ml.numeric(data, ml.LTV_FEATURES)).filter(~ml.split_column()).collect()]
    assert abs(mae - sum(errors) / len(errors)) < 1e-9


def test_training_partitions_follow_the_rows(spark, monkeypatch):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    assert ml.in_key_order(rows, "k").rdd.getNumPartitions() == 1
    monkeypatch.setattr(ml, "TRAIN_ROWS", 100)
    dealt = ml.in_key_order(rows, "k")
    assert dealt.rdd.getNumPartitions() == 10 and dealt.distinct().count() == 1000
    assert ml.in_key_order(rows.limit(0), "k").count() == 0
