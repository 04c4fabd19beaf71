"""The medallion jobs as written tables: bronze -> silver -> gold, each run logged.

Each job is one Spark write. Rows read and rows written are ``observe``
counters filled during that write (no extra scan), and every run appends a
row to the run log (S13), which feeds the run history (Q7) and the run-status
counts (A21). The silver jobs store their quality results, and every job
refreshes the catalog (S14) with its table's row count and size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightlake.operators import quality
from brightlake.operators.cleaning import clean_customers, clean_orders, clean_products
from brightlake.plans import gold, ops
from brightlake.sources.sinks import truncate_insert

# Run names of the six jobs.
RUN_NAMES = {"orders": "bronze_to_silver_orders", "customers": "bronze_to_silver_customers",
             "products": "bronze_to_silver_products", "daily": "silver_to_gold_daily_sales",
             "perf": "silver_to_gold_product_perf", "segments": "silver_to_gold_customer_seg"}


def run_medallion(spark: SparkSession, bronze: DataFrame, customers: DataFrame,
                  products: DataFrame, base: str, as_of, thresholds, tiers=None,
                  require_email: bool = True) -> DataFrame:
    """Write the three silver and three gold tables under ``base``; return the run log.

    Besides: ``base/dq_results`` (D1-D5 over silver), ``base/catalog``.
    """
    runs = f"{base}/run_log"
    entries: dict[str, tuple[str, str]] = {}

    def job(key, layer, name, read, plan, partition_by=None):
        counted, seen = ops.counted(read, key)
        out = plan(counted)
        path = f"{base}/{layer}/{name}"
        ops.write_observed(out.hint("rebalance", *partition_by) if partition_by else out, path,
                           RUN_NAMES[key], layer, rows_read=seen, partition_by=partition_by,
                           runs_path=runs)
        entries[name] = (layer, path)
        return spark.read.parquet(path)

    orders = job("orders", "silver", "orders", bronze, lambda d: clean_orders(d, as_of).withColumn(
        "created_month", F.trunc(F.col("created_at").cast("date"), "MM")), ["created_month"])
    people = job("customers", "silver", "customers", customers,
                 lambda d: clean_customers(d, as_of, require_email=require_email))
    goods = job("products", "silver", "products", products,
                lambda d: clean_products(d, as_of, **({"tiers": tiers} if tiers else {})))
    rules = {"orders": (orders, quality.order_rules()), "products": (goods, quality.product_rules()),
             "customers": (people, {k: v for k, v in quality.customer_rules().items()
                                    if k != "valid_email" or "email" in people.columns})}
    for name, (df, checks) in rules.items():
        quality.run_rules(df, name, "silver", checks, as_of).write.mode("append").parquet(
            f"{base}/dq_results")
    job("daily", "gold", "daily_sales", orders, gold.daily_sales)
    job("perf", "gold", "product_performance", orders,
        lambda d: gold.product_performance(d.drop("product_name", "category"), goods), ["period"])
    job("segments", "gold", "customer_segments", orders,
        lambda d: gold.customer_segments(d, people, as_of, thresholds))
    truncate_insert(ops.written_catalog(spark, entries, as_of), f"{base}/catalog")
    return spark.read.parquet(runs)
