"""Business-calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_year(c: Column, first_month: int = 4) -> Column:
    """The calendar year in which the fiscal year of a date began."""
    return F.year(c) - F.when(F.month(c) < first_month, 1).otherwise(0)


def fiscal_quarter(c: Column, first_month: int = 4) -> Column:
    since = F.pmod(F.month(c) - first_month, F.lit(12))
    return F.concat(F.lit("Q"), (F.floor(since / 3) + 1).cast("string"))


def is_weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def days_to_month_end(c: Column) -> Column:
    return F.datediff(F.last_day(c), c)


def event_time(millis: Column) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(millis)
