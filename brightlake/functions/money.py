"""Money arithmetic kept in DECIMAL until the final projection.

Rounding on decimals is HALF_UP (away from zero), the same in Spark and in
the SQL models, unlike rounding of binary doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"      # one amount
SUM_MONEY = "decimal(28,2)"  # a sum of amounts (exact up to 10^26)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded(x, digits: int = 2) -> Column:
    return F.round(_c(x), digits)


def div_round(num, den, digits: int = 2, num_type: str = "decimal(24,4)",
              den_type: str = "decimal(20,0)") -> Column:
    """``round(num / den, digits)`` computed exactly, NULL when ``den`` is 0.

    Both sides are cast to narrow decimals so Spark keeps >= 9 fractional
    digits in the quotient; the final HALF_UP rounding is then exact.
    """
    n = _c(num).cast(num_type)
    d = _c(den).cast(den_type)
    return F.round(F.try_divide(n, F.nullif(d, F.lit(0).cast(den_type))), digits)


def ratio_round(num, den, digits: int = 4) -> Column:
    """``round(count_a / count_b, digits)`` for two counts, exact."""
    return div_round(num, den, digits, "decimal(20,0)", "decimal(20,0)")


def pct_change(cur, prev, digits: int = 2) -> Column:
    """``round((cur - prev) / prev * 100, digits)`` for 2-decimal amounts, exact."""
    num = (_c(cur) - _c(prev)) * 10000   # scaled to an integer number of 1/100 cents
    den = _c(prev) * 100                 # integer cents
    return div_round(num, den, digits, "decimal(28,0)", "decimal(20,0)")


def share_pct(part, whole, digits: int = 2) -> Column:
    """``round(part / nullif(whole, 0) * 100, digits)`` for 2-decimal amounts, exact."""
    return div_round(_c(part) * 10000, _c(whole) * 100, digits, "decimal(28,0)", "decimal(20,0)")
