"""Arg-max and top-k per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def arg_max_per_group(df: DataFrame, keys, value_col: str, order_col: str,
                      tie_break: str | None = None, alias: str | None = None) -> DataFrame:
    """For each group, the ``value_col`` of the row with the largest ``order_col``.

    Ties go to the smallest ``tie_break``. ``min_by`` over a struct is an
    ordinary aggregate with partial combine: no window, no full sort, and a
    hot group is reduced map-side before the shuffle.
    """
    neg = -F.col(order_col)
    ordering = F.struct(neg.alias("o"), F.col(tie_break).alias("t")) if tie_break else neg
    return (df.filter(F.col(order_col).isNotNull())
              .groupBy(*keys)
              .agg(F.min_by(F.col(value_col), ordering).alias(alias or value_col)))


def top_k_per_group(df: DataFrame, keys, order_cols, k: int, rank_col: str = "rn") -> DataFrame:
    """Rows with ``row_number() <= k`` per group (order must be total).

    Catalyst inserts a ``WindowGroupLimit`` before the shuffle, so each map task
    forwards at most k rows per group.
    """
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
