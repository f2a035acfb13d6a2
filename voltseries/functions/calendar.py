"""Time parts. All of them read ``timestamp_ntz`` without the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts: Column | str) -> Column:
    return _col(ts).cast("date")


def staging_time_parts(ts: Column | str) -> list[Column]:
    """Hour, day, weekday (0 = Sunday), month, quarter and year columns."""
    ts = _col(ts)
    return [
        F.hour(ts).alias("hour_of_day"),
        F.dayofmonth(ts).alias("day_of_month"),
        (F.dayofweek(ts) - 1).alias("day_of_week"),
        F.month(ts).alias("month"),
        F.quarter(ts).alias("quarter"),
        F.year(ts).alias("year"),
    ]


def iso_weekday(ts: Column | str) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(_col(ts)) + 1
