"""Profiles, shares, skew reports and other aggregate shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.ordered import attach, row_positions


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def share_of_total(df: DataFrame, keys: Sequence[str], name: str = "pct_of_total") -> DataFrame:
    """Row count per group and its percentage of all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("total")).scalar()
    return counts.withColumn(name, F.round(F.col("row_count") * 100.0 / total, 2))


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: null_count, total_rows, null_pct. Reads the data once."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[count_where(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counted.unpivot("total_rows", columns, "column_name", "null_count").select(
        "column_name",
        "null_count",
        "total_rows",
        F.round(F.try_divide(F.col("null_count") * 100.0, "total_rows"), 2).alias("null_pct"),
    )


def table_profile(df: DataFrame, key: str, date: str, amount: str) -> DataFrame:
    """Size, key, date and amount statistics in a single aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(key).alias("unique_keys"),
        F.min(date).alias("earliest_date"),
        F.max(date).alias("latest_date"),
        F.datediff(F.max(date), F.min(date)).alias("date_range_days"),
        F.round(F.sum(amount), 2).alias("total_amount"),
        F.round(F.avg(amount), 2).alias("avg_amount"),
        F.round(F.stddev(amount), 2).alias("std_amount"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        F.percentile_approx(amount, 0.5, 10_000).alias("median_amount"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def duplicate_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows, from counts per key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.sum("n").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"),
        count_where(F.col("n") > 1).alias("duplicated_keys"),
    )


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition of ``df`` as it stands."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def hot_key_report(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their ratio to the median key.

    The exact median is taken over row *counts*, which repeat heavily, so its state stays
    small however many keys there are.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    median = counts.agg(F.median("rows").alias("m")).scalar()
    return counts.withColumn("ratio_to_median", F.round(F.col("rows") / median, 4))


def word_counts(df: DataFrame, text: str, separator: str = r"\s+") -> DataFrame:
    """Occurrences of each word over whole texts."""
    words = df.select(F.explode(F.split(F.col(text), separator)).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def collect_chunks(
    df: DataFrame,
    keys: Sequence[str],
    item: Column,
    order: Sequence[Column],
    size: int = 10_000,
    block: Column | None = None,
    name: str = "items",
) -> DataFrame:
    """Ordered lists per key in pieces of at most ``size`` items, so no row grows without
    bound. A key with up to ``size`` rows gives one row with ``chunk`` 0."""
    placed = row_positions(df, keys, order, block, "_pos").withColumn("_item", item)
    chunk = F.floor((F.col("_pos") - 1) / size).alias("chunk")
    pairs = F.array_sort(F.collect_list(F.struct(F.col("_pos"), F.col("_item"))))
    return placed.groupBy(*keys, chunk).agg(F.transform(pairs, lambda p: p["_item"]).alias(name))


def daily_comparison(df: DataFrame, day: str, amount: str) -> DataFrame:
    """Totals per day beside the day before and the same day last week.

    The windows run over one row per calendar day, never over the input rows.
    """
    daily = df.groupBy(day).agg(F.sum(amount).alias("total"))
    w = Window.orderBy(day)

    def change(before: Column) -> Column:
        return F.round((F.col("total") - before) / before * 100, 2)

    return daily.select(
        day,
        F.round("total", 2).alias("total"),
        F.round(F.lag("total", 1).over(w), 2).alias("previous_row"),
        change(F.lag("total", 1).over(w)).alias("change_pct"),
        F.round(F.lag("total", 7).over(w), 2).alias("seven_rows_before"),
        change(F.lag("total", 7).over(w)).alias("change_7_pct"),
    )
