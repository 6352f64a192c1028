"""Trailing-window predicates with an explicit clock.

The windows have a lower bound only (rows after ``as_of`` count too), as
in the reference models. ``as_of`` is always a literal argument, never
``current_timestamp()``, so a rerun over the same data gives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_timestamp(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        as_of = dt.datetime(as_of.year, as_of.month, as_of.day)
    return F.lit(as_of.replace(tzinfo=None)).cast("timestamp_ntz")


def as_date(as_of) -> Column:
    return F.to_date(as_timestamp(as_of))


def trailing_window(ts, as_of, days: int = 30) -> Column:
    """``ts >= as_of - days`` on a timestamp column (pushed to the scan)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c >= as_timestamp(as_of) - F.make_dt_interval(F.lit(days))


def trailing_date_window(d, as_of, days: int = 30) -> Column:
    """``d >= date(as_of) - days`` on a date column."""
    c = F.col(d) if isinstance(d, str) else d
    return c >= F.date_sub(as_date(as_of), days)


DAY = "event_day"  # partition column of events laid out by day


def trailing_rows(df: DataFrame, ts: str, as_of, days: int = 30) -> DataFrame:
    """The rows of ``df`` in the trailing window. Where the frame is laid out by day, the window is said of the day as
    well: folders before it are never listed or read."""
    rows = df.filter(trailing_window(ts, as_of, days))
    if DAY in df.columns:
        rows = rows.filter(F.col(DAY) >= F.to_date(as_timestamp(as_of) - F.make_dt_interval(F.lit(days))))
    return rows
