"""Date/time helpers. ``as_of`` is always explicit (never ``current_date``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date_lit(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    return F.lit(as_of).cast("date")


def as_ts_lit(as_of) -> Column:
    """A wall-clock timestamp (``timestamp_ntz``, like the landed data)."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else as_of.isoformat()
    return F.lit(as_of).cast("timestamp_ntz")


def parse_ts(x) -> Column:
    """ISO-8601 text to timestamp; unparseable text becomes NULL (ANSI-safe)."""
    return F.try_to_timestamp(_c(x)).cast("timestamp_ntz")


def days_since(as_of, x) -> Column:
    """Whole days from ``x`` (date or timestamp) to ``as_of``; negative for future."""
    return F.datediff(as_date_lit(as_of), _c(x).cast("date"))


def period(x) -> Column:
    """``yyyy-MM`` period text of a timestamp."""
    return F.date_format(_c(x), "yyyy-MM")


def month_start(x) -> Column:
    """Month transform used for partitioned writes."""
    return F.trunc(_c(x).cast("date"), "MM")
