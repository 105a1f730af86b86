"""Casting, standardising and bucketing of raw columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(c: Column) -> Column:
    """Plain decimal text as a double; anything else (``NaN`` and ``1d`` included) is NULL."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def to_money(c: Column) -> Column:
    """Money text with thousands commas and currency signs as a double."""
    return to_number(F.regexp_replace(c, "[,$₹]", ""))


def to_date(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """A date, or NULL when the text is not one."""
    return F.to_date(F.try_to_timestamp(c, F.lit(pattern)))


def code(c: Column) -> Column:
    """A code in capitals without surrounding blanks."""
    return F.upper(F.trim(c))


def bucket(c: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by the first bound the value is below; the last label has none. NULL stays NULL."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one more label than bounds")
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        out = out.when(c < bound, label)
    return out.otherwise(labels[-1])


# The default amount categories.
AMOUNT_BOUNDS = (100, 1000, 10000)
AMOUNT_LABELS = ("LOW", "MEDIUM", "HIGH", "PREMIUM")


def amount_category(c: Column) -> Column:
    return bucket(c, AMOUNT_BOUNDS, AMOUNT_LABELS)


def multi_select(c: Column, chosen: Sequence[str], everything: str = "All") -> Column:
    """Membership in a list of job arguments, where one value means no restriction."""
    return F.lit(True) if everything in chosen else c.isin(*chosen)
