"""Calendar attributes of the date dimension and report labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal, parsed from its ISO text (no time zone involved).

    ``F.lit(datetime)`` would make a session-time-zone timestamp, and comparing
    it with ``timestamp_ntz`` columns would depend on the Python process and
    the session agreeing on the zone.
    """
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_series(start: Column, end: Column) -> Column:
    """Inclusive daily series start..end as an array (exploded by callers)."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def iso_weekday(d: Column) -> Column:
    """Mon=1 ... Sun=7 (``dayofweek`` is Sun=1, so use ``weekday`` + 1)."""
    return (F.weekday(d) + 1).cast("short")


def quarter(d: Column) -> Column:
    return F.quarter(d).cast("short")


def month_name(d: Column) -> Column:
    """Full English month name without padding (``FMMonth``)."""
    return F.date_format(d, "MMMM")


def calendar_columns(d: Column) -> list[Column]:
    return [
        F.year(d).cast("short").alias("year"),
        F.month(d).cast("short").alias("month"),
        F.dayofmonth(d).cast("short").alias("day"),
        quarter(d).alias("quarter"),
        iso_weekday(d).alias("weekday"),
        month_name(d).alias("month_name"),
    ]


def year_month(d: Column) -> Column:
    """yyyymm as an int: the fact's storage partition value."""
    return (F.year(d) * 100 + F.month(d)).cast("int")


def period_label(year: Column, month: Column) -> Column:
    """'YYYY-MM' from year and month numbers."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def axis_label(period: Column, category: Column) -> Column:
    """The two-part label of a bar: the period over the category."""
    return F.concat_ws("\n", period, category)


def month_in_range(year: Column, month: Column, y0: int, m0: int, y1: int, m1: int) -> Column:
    """(year, month) between (y0, m0) and (y1, m1), both ends inclusive."""
    lo = (year > y0) | ((year == y0) & (month >= m0))
    hi = (year < y1) | ((year == y1) & (month <= m1))
    return lo & hi
