"""Business CASE rules as column expressions with parameterised thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
ORDER_STATUSES = ["completed", "refunded", "cancelled"]
CUSTOMER_SEGMENTS = ["standard", "premium", "vip"]
PRICE_TIERS = (50, 200, 500)                 # budget < 50 <= mid < 200 <= premium < 500 <= luxury
SEGMENT_THRESHOLDS = (3000, 1000, 180, 1)    # vip spend, premium spend, at-risk days, new max orders
CLV_CAP_SEGMENTS = 999999.9999
CLV_CAP_FEATURES = 999999.0
RISK_HIGH, RISK_MEDIUM = 0.7, 0.4


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def price_tier(price, tiers=PRICE_TIERS) -> Column:
    lo, mid, hi = tiers
    p = _c(price)
    return (F.when(p < lo, "budget").when(p < mid, "mid").when(p < hi, "premium")
            .otherwise("luxury"))


def customer_segment(total_spent, days_since_last, order_count,
                     thresholds=SEGMENT_THRESHOLDS) -> Column:
    vip, premium, at_risk_days, new_orders = thresholds
    s, d, n = _c(total_spent), _c(days_since_last), _c(order_count)
    return (F.when(s > vip, "vip").when(s > premium, "premium")
            .when(d > at_risk_days, "at_risk").when(n <= new_orders, "new")
            .otherwise("regular"))


def rfm_segment(m, f, r) -> Column:
    # Segment names, bounds and the order of the branches.
    m, f, r = _c(m), _c(f), _c(r)
    return (F.when((m == 4) & (f == 4), "champion")
            .when((m >= 3) & (f >= 3), "loyal")
            .when(r == 4, "new")
            .when((r <= 2) & (m >= 3), "at_risk")
            .otherwise("regular"))


def risk_level(p) -> Column:
    """Served per-customer risk: > 0.7 high, > 0.4 medium, else low (0.4 is low)."""
    p = _c(p)
    return F.when(p > RISK_HIGH, "high").when(p > RISK_MEDIUM, "medium").otherwise("low")
