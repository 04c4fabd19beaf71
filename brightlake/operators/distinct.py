"""Exact distinct counts that merge (A1, A14): bitmaps of integer ids.

The ids of one day are bits of one bitmap for each range of 32,768 ids, built with a map-side
aggregate. Bitmaps of several days, or of several batches of one day, merge by OR, so any period's
exact distinct count comes from the stored days without the rows. A bitmap is 4 KB whatever
the rows, and no group holds more than the bitmaps of one id range and period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_bitmaps(rows: DataFrame, day: str, key: str) -> DataFrame:
    """``day``, ``id_range``, ``ids``: the distinct integers ``key`` of each day; null ids are not
    counted, and rows without a day are one group of their own."""
    return (rows.filter(F.col(key).isNotNull())
            .groupBy(day, F.bitmap_bucket_number(key).alias("id_range"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("ids")))


def merge_bitmaps(bitmaps: DataFrame, day: str) -> DataFrame:
    """Bitmaps of one day and range as one: of several batches, or after a union of tables."""
    return bitmaps.groupBy(day, "id_range").agg(F.bitmap_or_agg("ids").alias("ids"))


def spread(bitmaps: DataFrame, day: str, days: int) -> DataFrame:
    """For each day and range, the OR of the ``days`` days up to it (a power of two) - also
    for days without rows of their own. Each step doubles the period: two rows a bitmap."""
    out, span = bitmaps, 1
    while span < days:
        later = F.explode(F.array(F.col(day), F.date_add(day, span)))
        out = merge_bitmaps(out.select(later.alias(day), "id_range", "ids"), day)
        span *= 2
    return out


def rolling_distinct(bitmaps: DataFrame, day: str, periods=(7, 30), name: str = "distinct") -> DataFrame:
    """``day`` and ``<name>_<n>d`` for each period of ``n`` days up to each day that has rows.

    A period is the union of two spans of the greatest power of two within it. Rows without
    a day have no period and are left out.
    """
    known = merge_bitmaps(bitmaps.filter(F.col(day).isNotNull()), day)
    out = known.select(day).distinct()
    for n in periods:
        span = 1 << (n.bit_length() - 1)
        shifts = sorted({0, n - span})
        whole = spread(known, day, span)
        if len(shifts) > 1:
            later = F.explode(F.array(*[F.date_add(day, s) for s in shifts]))
            whole = merge_bitmaps(whole.select(later.alias(day), "id_range", "ids"), day)
        counts = whole.groupBy(day).agg(F.sum(F.bitmap_count("ids")).alias(f"{name}_{n}d"))
        out = out.join(counts, day)
    return out
