"""Exact distributed global row number and NTILE (W8 at scale).

``ntile(k) OVER (ORDER BY ...)`` without ``PARTITION BY`` makes Spark plan an
``Exchange SinglePartition``: every row in one task. Here the rows are range
partitioned on the (total) order, sorted inside each partition, numbered
locally, and shifted by the prefix sum of the per-partition counts (one tiny
row per partition, so broadcasting the offsets has a proven size bound).
Counting and numbering must see the same partitions, so the columns given are
written once in between: pass only those that the order and a later join need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightlake.session import written

#: Rows of one range partition, about.
RANGE_ROWS = 2_000_000


def range_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions to number ``rows`` rows in."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))


def global_row_number(df: DataFrame, order_cols: list[Column], rn_col: str = "rn",
                      total_col: str | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``rn`` = 1..n in the total order ``order_cols`` (and optionally ``n``)."""
    spark = df.sparkSession
    n_parts = num_partitions
    if not n_parts:
        df = written(df, "row-number-input")   # counted from its footers, and read once more
        n_parts = range_partitions(spark, df.count())
    ranged = (df.repartitionByRange(n_parts, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = written(ranged, "row-number")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding,
                                                    Window.unboundedFollowing)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(everything).alias("_total"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = (ranged.join(F.broadcast(offsets), "_pid")
                 .withColumn(rn_col, F.col("_off") + local + 1))
    if total_col:
        out = out.withColumnRenamed("_total", total_col)
    return out.drop("_pid", "_mid", "_off", "_total")


def ntile_of(rn, n, k: int) -> Column:
    """Bucket of row ``rn`` (1-based) among ``n`` rows split into ``k`` tiles (SQL NTILE)."""
    rn, n = F.col(rn) if isinstance(rn, str) else rn, F.col(n) if isinstance(n, str) else n
    q = F.floor(n / k).cast("long")
    r = (n % k).cast("long")
    big = r * (q + 1)
    small_q = F.greatest(q, F.lit(1))
    return (F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1)
             .otherwise(r + F.floor((rn - big - 1) / small_q) + 1)).cast("int")


def distributed_ntile(df: DataFrame, k: int, order_cols: list[Column], out_col: str,
                      num_partitions: int | None = None) -> DataFrame:
    """Exact ``ntile(k) OVER (ORDER BY order_cols)``; ``order_cols`` must be a total order."""
    numbered = global_row_number(df, order_cols, "_rn", "_n", num_partitions)
    return numbered.withColumn(out_col, ntile_of("_rn", "_n", k)).drop("_rn", "_n")
