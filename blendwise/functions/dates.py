"""Date helpers (D1-D10): period starts, Sunday weeks, period lengths, spines.

All helpers return DateType columns. ``date_trunc`` yields a timestamp in Spark,
so periods are computed with ``trunc`` on a date, which stays a date and never
touches the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blendwise.constants import GRAINS
from blendwise.functions.columns import as_col


def to_date(c) -> Column:
    """Cast a date, timestamp or ISO text column to DateType."""
    return as_col(c).cast("date")


def date_lit(value) -> Column:
    """An ISO date literal compared to a date."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat()[:10]
    return F.lit(value).cast("date")


def period_start(c, grain: str, week_start: str = "monday") -> Column:
    """First day of the period that contains ``c``.

    ``week_start='sunday'`` gives ``date_trunc('week', d + 1) - 1``.
    """
    d = to_date(c)
    if grain == "day":
        return d
    if grain == "week" and week_start == "sunday":
        return F.date_sub(F.trunc(F.date_add(d, 1), "week"), 1)
    if grain == "week" and week_start != "monday":
        raise ValueError(f"unknown week_start {week_start!r}")
    if grain not in GRAINS:
        raise ValueError(f"unknown granularity {grain!r}")
    return F.trunc(d, grain)


def days_in_month(c) -> Column:
    """Days of the month that contains ``c``."""
    return F.dayofmonth(F.last_day(to_date(c))).cast("long")


def days_in_quarter(c) -> Column:
    """Days of the quarter that contains ``c``."""
    start = F.trunc(to_date(c), "quarter")
    return F.datediff(F.add_months(start, 3), start).cast("long")


def days_in_year(c) -> Column:
    """Days of the year that contains ``c``."""
    start = F.trunc(to_date(c), "year")
    return F.datediff(F.add_months(start, 12), start).cast("long")


def with_date_parts(df: DataFrame, date_col: str, grains=GRAINS,
                    week_start: str = "monday") -> DataFrame:
    """Add one period-start column per grain, named after the grain."""
    return df.withColumns(
        {g: period_start(date_col, g, week_start) for g in grains})


def calendar_spine(spark: SparkSession, start, end=None, name: str = "date") -> DataFrame:
    """One row per date from ``start`` to ``end`` inclusive.

    ``end`` defaults to the current date. The spine is generated by Spark
    (``sequence`` + ``explode``); its size is the number of days in the range.
    """
    end_col = F.current_date() if end is None else date_lit(end)
    return spark.range(1).select(
        F.explode(F.sequence(date_lit(start), end_col)).alias(name))
