"""Driver tables -> the order / customer / product shapes of the pipeline.

Crosswalk (one fixed mapping, used by every registered query):

* order line  = lineitem joined to its order (``l_orderkey = o_orderkey``)
* order_id    = ``<l_orderkey>-<l_linenumber>`` (not unique: duplicates exist,
  which the silver dedupe removes)
* customer_id = ``o_custkey``; product_id = ``l_partkey``
* product_name / category = ``p_name`` / ``p_type`` (only joined when asked)
* quantity    = ``l_quantity``; unit_price = ``round(extendedprice / quantity, 2)``
* total_amount = ``round(extendedprice * (1 - discount), 2)`` in DECIMAL
* status      = returnflag N -> completed, R -> refunded, A -> cancelled
* created_at  = ``o_orderdate``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightlake.functions.money import MONEY
from brightlake.sources.tables import table

# Return flag -> order status.
STATUS_OF_FLAG = {"N": "completed", "R": "refunded", "A": "cancelled"}
ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def _status(flag) -> F.Column:
    expr = F.when(flag == "N", STATUS_OF_FLAG["N"])
    expr = expr.when(flag == "R", STATUS_OF_FLAG["R"]).when(flag == "A", STATUS_OF_FLAG["A"])
    return expr


def order_lines(spark: SparkSession, base_dir: str, with_product: bool = True) -> DataFrame:
    """Silver-shaped order lines from ``lineitem`` x ``orders`` (x ``part``)."""
    li = table(spark, base_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag")
    od = table(spark, base_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    df = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    ep = F.col("l_extendedprice").cast(MONEY)
    disc = F.col("l_discount").cast("decimal(4,2)")
    qty = F.col("l_quantity").cast("bigint")
    cols = [
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.round(ep / qty.cast("decimal(10,0)"), 2).cast(MONEY).alias("unit_price"),
        qty.alias("quantity"),
        disc.alias("discount"),
        F.round(ep * (F.lit(1) - disc), 2).cast(MONEY).alias("total_amount"),
        _status(F.col("l_returnflag")).alias("status"),
        F.col("o_orderdate").alias("created_at"),
    ]
    out = df.select(*cols)
    if with_product:
        part = table(spark, base_dir, "part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"))
        # part is a dimension; Spark/AQE broadcasts it only when its measured size
        # is under the broadcast threshold, otherwise it is a shuffle join.
        out = out.join(part, "product_id", "left")
    out = out.withColumn("order_date", F.to_date("created_at"))
    return out


BRONZE_ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "product_name", "category",
                        "unit_price", "quantity", "discount", "total_amount", "status",
                        "created_at"]


def bronze_order_lines(spark: SparkSession, base_dir: str) -> DataFrame:
    """Landed (bronze) shape: the order lines with ``created_at`` as ISO-8601 text."""
    lines = order_lines(spark, base_dir, with_product=True)
    iso = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at")
    return lines.select(*[iso if c == "created_at" else F.col(c) for c in BRONZE_ORDER_COLUMNS])


def customers(spark: SparkSession, base_dir: str) -> DataFrame:
    """Customer dimension: id, name, segment (market segment), country (nation)."""
    c = table(spark, base_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), "c_nationkey")
    n = table(spark, base_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return c.join(n, "c_nationkey", "left").drop("c_nationkey")


def products(spark: SparkSession, base_dir: str) -> DataFrame:
    """Product dimension: id, name, category, base_price, stock (size), rating (none)."""
    return table(spark, base_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("base_price"),
        F.col("p_size").cast("bigint").alias("stock"),
        F.lit(None).cast("double").alias("rating"))


def events(spark: SparkSession, base_dir: str) -> DataFrame:
    return table(spark, base_dir, "events")
