"""Point-in-time (as-of) feature join with TTL (J6) and the online view.

For each spine row (entity, t) the latest feature row with the same entity
and ``event_ts <= t`` is attached, or NULL when it is older than ``t - ttl``;
among equal event times the later ``created`` wins.

Hot entities: the window is partitioned by (entity, time bucket), not by
entity alone. Buckets are ``ceil(ttl / split)`` wide. Every feature row stays in
its own bucket; only the last one of each (entity, bucket) is also carried into
the following ``split`` buckets, which is the look-back the TTL allows. So an
entity holding a third of all rows is spread over its buckets, a larger
``split`` spreads it further, and the answer does not depend on it.

A NULL entity matches nothing.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightlake.functions.dates import as_ts_lit
from brightlake.operators.dedupe import latest_by


def _secs(ttl) -> float:
    return ttl.total_seconds() if isinstance(ttl, _dt.timedelta) else float(ttl)


def _interval(ttl):
    return F.make_interval(secs=F.lit(f"{_secs(ttl):.6f}").cast("decimal(18,6)"))


def _seconds(df: DataFrame, c: str):
    """Whole seconds on the same clock the TTL is measured on.

    Wall-clock (``timestamp_ntz``) columns are counted without any time zone, so
    a daylight-saving shift can never move a row out of the buckets its TTL allows.
    """
    col = F.col(c)
    if df.schema[c].dataType.simpleString() == "timestamp_ntz":
        return (F.unix_date(col.cast("date")).cast("long") * 86400 + F.hour(col) * 3600
                + F.minute(col) * 60 + F.floor(F.second(col)))
    return F.unix_seconds(col)


def asof_join(spine: DataFrame, features: DataFrame, key: str, spine_ts: str,
              feature_ts: str, feature_cols: list[str], ttl, created: str | None = None,
              split: int = 8) -> DataFrame:
    """Attach ``feature_cols`` (and ``feature_ts``) to every spine row."""
    width = max(math.ceil(_secs(ttl) / max(split, 1)), 1)
    made = features.schema[created].dataType if created else "long"
    payload_cols = list(dict.fromkeys([feature_ts] + feature_cols + ([created] if created else [])))
    feat = features.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.col(feature_ts).alias("_t"),
        (F.col(created) if created else F.lit(None)).cast(made).alias("_c"),
        F.struct(*[F.col(c) for c in payload_cols]).alias("_f"),
        F.floor(_seconds(features, feature_ts) / width).alias("_b"))
    last = feat.groupBy("_k", "_b").agg(F.max(F.struct("_t", "_c", "_f")).alias("_l")).select(
        "_k", F.col("_l._t").alias("_t"), F.col("_l._c").alias("_c"), F.col("_l._f").alias("_f"),
        F.explode(F.sequence(F.col("_b") + 1, F.col("_b") + max(split, 1))).alias("_b"))
    spine_cols = spine.columns
    known = spine.filter(F.col(key).isNotNull())
    sp = known.select(
        F.col(key).alias("_k"), F.col(spine_ts).alias("_t"), F.lit(None).cast(made).alias("_c"),
        F.lit(None).cast(feat.schema["_f"].dataType).alias("_f"),
        F.floor(_seconds(spine, spine_ts) / width).alias("_b"), F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in spine_cols]).alias("_s"))
    both = (feat.unionByName(last).withColumn("_side", F.lit(0))
            .withColumn("_s", F.lit(None).cast(sp.schema["_s"].dataType)).unionByName(sp))
    w = (Window.partitionBy("_k", "_b").orderBy("_t", "_side", "_c")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    matched = (both.withColumn("_m", F.last("_f", ignorenulls=True).over(w))
                   .filter(F.col("_side") == 1))
    fresh = F.col(f"_m.{feature_ts}") >= F.col("_t") - _interval(ttl)
    out_feats = [F.when(fresh, F.col(f"_m.{c}")).alias(c) for c in [feature_ts] + feature_cols]
    found = matched.select(*[F.col(f"_s.{c}").alias(c) for c in spine_cols], *out_feats)
    unknown = spine.filter(F.col(key).isNull()).select(
        *spine_cols, *[F.lit(None).cast(features.schema[c].dataType).alias(c)
                       for c in [feature_ts] + feature_cols])
    return found.unionByName(unknown)


def online_features(features: DataFrame, key: str, feature_ts: str, as_of, ttl,
                    created: str | None = None) -> DataFrame:
    """Latest feature row per entity at ``as_of`` that is not older than ``ttl``.

    The TTL window is applied before the per-key pick so the scan filter is
    pushed down; the pick is a partial aggregate (hot keys fold map-side).
    """
    now = as_ts_lit(as_of)
    live = features.filter((F.col(feature_ts) <= now)
                           & (F.col(feature_ts) >= now - _interval(ttl)))
    version = [feature_ts] + ([created] if created else [])
    return latest_by(live, [key], version)
