"""Deterministic "pick one row per key" operators.

All are ``groupBy(keys).agg(min/max(struct(...)))``: a hash/sort aggregate
with map-side partial combine, so a key holding a third of all rows is
folded inside each map task before the shuffle, and the choice is a total
order (order columns first, then every other column), never arbitrary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys, order_cols, latest: bool, count_col: str | None = None) -> DataFrame:
    """NULL order values come last: a row with a known order beats one without."""
    keys = list(keys)
    order_cols = [c for c in order_cols if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    known = [F.col(c).isNotNull() if latest else F.col(c).isNull() for c in order_cols]
    packed = F.struct(*[x for c, k in zip(order_cols, known) for x in (k.alias(f"_null_{c}"), F.col(c))],
                      *[F.col(c) for c in rest])
    agg = F.max(packed) if latest else F.min(packed)
    more = [count_col] if count_col else []
    picked = df.groupBy(*keys).agg(agg.alias("_row"), *[F.count(F.lit(1)).alias(c) for c in more])
    return picked.select(*[F.col(k) for k in keys],
                         *[F.col(f"_row.{c}").alias(c) for c in order_cols + rest],
                         *more).select(*df.columns, *more)


def first_by_key(df: DataFrame, keys, order_cols=(), count_col: str | None = None) -> DataFrame:
    """Keep, per key, the row that sorts first by ``order_cols`` then all other columns;
    ``count_col`` adds the number of the key's rows."""
    return _pick(df, keys, order_cols, latest=False, count_col=count_col)


def latest_by(df: DataFrame, keys, version_cols) -> DataFrame:
    """Keep, per key, the row with the greatest version (ties: greatest full row)."""
    if isinstance(version_cols, str):
        version_cols = [version_cols]
    return _pick(df, keys, version_cols, latest=True)


def first_of_ids(df: DataFrame, key: str, order_cols=(), count_col: str | None = None) -> DataFrame:
    """``first_by_key`` for ids, of which few rows are equal: rows meet by id first and are sorted
    once, in as many tasks as the session's shuffles have. A fold before the shuffle would sort
    all rows as well, in tasks that may be far larger, and drop few. Rows without an id are left
    out: they are no key's, however many there are.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return first_by_key(df.filter(F.col(key).isNotNull()).repartition(parts, key), [key], order_cols, count_col)
