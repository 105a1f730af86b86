"""Word-level text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(c: Column) -> Column:
    """Non-empty words separated by white space."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring tokens joined by a blank; empty when there are fewer."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
    runs = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))
    return F.coalesce(runs, F.array().cast("array<string>"))
