"""Exact distributed RANK and group totals (W6, W7 without a per-group window).

``rank() OVER (PARTITION BY g ORDER BY v)`` moves every row of a group into
one task, so a group holding a third of all rows (one busy period) becomes a
single straggler. Here the rows are numbered in the total order
``(g, v, tie_break)`` with the range-partitioned global row number, which
splits a hot group (and a hot tie) over many tasks. Then:

* the first row number of each tie ``(g, v)`` and of each group ``g`` come
  from ordinary aggregates (partial combine before the shuffle);
* ``rank = first(tie) - first(group) + 1``, which is SQL RANK: one more than
  the number of rows of the group ordered strictly before the tie.

Tie groups and groups are joined back by null-safe equality, so NULL values
tie with each other as they do in a window. AQE broadcasts the tie table only
when its measured size is under the threshold and splits a hot tie on the
row side of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightlake.operators.ntile import global_row_number


def _sort_order(c: Column, descending: bool, nulls_first: bool) -> Column:
    if descending:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL; keeps the left key columns."""
    tmp = [f"_jk{i}" for i in range(len(keys))]
    r = right.select(*[F.col(k).alias(t) for k, t in zip(keys, tmp)],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[t]) for k, t in zip(keys, tmp)]
    return left.join(r, cond, how).drop(*tmp)


def rank_table(df: DataFrame, group: list[str], value: str, out: str,
               tie_break: list[str] = (), descending: bool = True,
               nulls_first: bool = True, num_partitions: int | None = None) -> DataFrame:
    """One row per distinct ``(group, value)`` with its SQL RANK within the group.

    Only the slim projection ``(group, value, tie_break)`` is numbered.
    ``tie_break`` does not change the ranks; it only lets the range
    partitioner split a value that many rows share.
    """
    order = ([F.col(g).asc_nulls_first() for g in group]
             + [_sort_order(F.col(value), descending, nulls_first)]
             + [F.col(t).asc_nulls_first() for t in tie_break])
    slim = df.select(*group, value, *tie_break)
    numbered = global_row_number(slim, order, "_rn", num_partitions=num_partitions)
    keys = [*group, value]
    ties = numbered.groupBy(*keys).agg(F.min("_rn").alias("_tie_first"))
    starts = ties.groupBy(*group).agg(F.min("_tie_first").alias("_grp_first"))
    return (join_null_safe(ties, starts, list(group))
            .select(*keys, (F.col("_tie_first") - F.col("_grp_first") + 1).cast("int").alias(out)))


def rank_within_group(df: DataFrame, group: list[str], value: str, out: str,
                      tie_break: list[str] = (), descending: bool = True,
                      nulls_first: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = ``rank() OVER (PARTITION BY group ORDER BY value ...)``, exactly."""
    ranks = rank_table(df, group, value, out, tie_break, descending, nulls_first, num_partitions)
    return join_null_safe(df, ranks, [*group, value])


def with_group_total(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Add ``out`` = ``sum(value) OVER (PARTITION BY group)`` as aggregate + join.

    The aggregate combines map-side, so a hot group never lands whole in one
    task; the totals table has one row per group.
    """
    return join_null_safe(df, group_totals(df, group, value, out), list(group))


def group_totals(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """One row per group with ``sum(value)`` (map-side combined)."""
    return df.groupBy(*group).agg(F.sum(value).alias(out))
