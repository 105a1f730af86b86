"""Date spines, missing intervals and hierarchies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeloom.session import stage


def date_spine(bounds: DataFrame, first: Column, last: Column, name: str = "dt") -> DataFrame:
    """One row per day between two dates of a one-row frame."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(name))


def missing_dates(df: DataFrame, day: str) -> DataFrame:
    """Days between the first and last date of ``df`` that have no row."""
    days = df.select(day).distinct()
    bounds = days.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    spine = date_spine(bounds, F.col("lo"), F.col("hi"), "missing_date")
    return spine.join(days, F.col("missing_date") == F.col(day), "left_anti")


def batch_windows(bounds: DataFrame, start: Column, end: Column, hours: int) -> DataFrame:
    """Tumbling windows of fixed length that cover ``[start, end)``."""
    step = F.expr(f"interval {int(hours)} hours")
    begin = F.explode(F.sequence(start, end - F.expr("interval 1 microsecond"), step))
    return bounds.select(begin.alias("window_start")).withColumn(
        "window_end", F.col("window_start") + step
    )


def pending_windows(windows: DataFrame, done: DataFrame) -> DataFrame:
    """Windows without a finished run."""
    return windows.join(done, ["window_start", "window_end"], "left_anti")


def hierarchy(
    df: DataFrame,
    node: str,
    parent: str,
    label: str,
    max_depth: int | None = None,
    separator: str = " > ",
) -> DataFrame:
    """``node, level, path`` for every way from a root (no parent) to a node, roots at level 1.

    Path doubling: every row is a stretch of the way up and knows the node above it; each
    round puts the stretch above in front of it, so a tree of ``d`` levels takes ``log2(d)``
    rounds of one join. Rounds are staged in the shared folder, so a lost executor costs at
    most one.

    A node with several parents has one row for each way, as a recursive query lists it.
    Nodes above which a parent is missing are not reached and not listed. A cycle raises: ways
    that stay open after ``s`` steps pass only through nodes that are open too, so ``o`` such
    rows allow at most ``s + o`` levels. A level below ``max_depth`` raises, where given.
    """
    way = df.select(
        F.col(node).alias("node"),
        F.col(parent).alias("up"),
        F.lit(1).alias("level"),
        F.col(label).cast("string").alias("path"),
    )
    def staged(rows: DataFrame) -> tuple[DataFrame, int]:
        """The rows and how many are open, counted by the job that writes them."""
        counted = Observation()
        rows = stage(rows.observe(counted, F.count("up").alias("open")), "hierarchy")
        return rows, counted.get["open"]

    way, n_open = staged(way)
    found, steps, most = way.where("up IS NULL"), 1, None
    while n_open:
        still = way.where("up IS NOT NULL")
        most = steps + n_open if most is None else min(most, steps + n_open)
        if steps >= most:
            raise ValueError("the hierarchy has a cycle")
        above = found.unionByName(still).select(
            F.col("node").alias("above"),
            F.col("up").alias("next_up"),
            F.col("level").alias("levels_above"),
            F.col("path").alias("path_above"),
        )
        way, n_open = staged(
            still.join(above, F.col("up") == F.col("above")).select(
                "node",
                F.col("next_up").alias("up"),
                (F.col("level") + F.col("levels_above")).alias("level"),
                F.concat("path_above", F.lit(separator), "path").alias("path"),
            )
        )
        found = found.unionByName(way.where("up IS NULL"))
        steps *= 2
    found = found.drop("up")
    if max_depth is not None and not found.where(F.col("level") > max_depth).isEmpty():
        raise ValueError(f"the hierarchy has more than {max_depth} levels")
    return found


def difference_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")
