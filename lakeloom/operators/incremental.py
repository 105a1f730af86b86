"""Watermark-driven incremental loads and idempotent batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.merge import upsert
from lakeloom.operators.ordered import latest_per_key

WATERMARK_SCHEMA = "pipeline_name string, watermark_value timestamp, updated_at timestamp"


@dataclass(frozen=True)
class Load:
    target: DataFrame
    watermark: DataFrame
    stats: DataFrame
    #: Rows that no later load would see because their watermark column is NULL.
    without_watermark: DataFrame


def incremental_load(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    watermark_column: str,
    watermark: Any | None,
    tie: Sequence[str] = (),
) -> Load:
    """Upsert the rows at or after ``watermark`` (``None`` takes everything).

    ``>=`` reads rows tied with the saved maximum again, which the upsert absorbs. The
    bound is a literal, so it reaches the file scan. Statistics and the new watermark are
    one-row frames computed from counts per key. Rows whose watermark column is NULL can't be
    placed before or after the bound: they are counted and handed back, not merged unseen.
    """
    unplaced = source.where(F.col(watermark_column).isNull())
    fresh = source
    if watermark is not None:
        fresh = source.where(F.col(watermark_column) >= F.lit(watermark))
    else:
        unplaced = unplaced.limit(0)
    order = [F.col(watermark_column).desc(), *[F.col(c).desc() for c in tie]]
    merged = upsert(target, latest_per_key(fresh, keys, order), keys)
    per_key = fresh.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max(watermark_column).alias("newest")
    )
    stats = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records_read"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count(F.lit(1)).alias("records_merged"),
        F.coalesce(F.max("newest"), F.lit(watermark)).alias("new_watermark"),
    ).withColumn("status", F.when(F.col("records_read") == 0, "SKIPPED").otherwise("SUCCESS"))
    left = unplaced.agg(F.count(F.lit(1)).alias("records_without_watermark"))
    stats = stats.crossJoin(left)  # one row each
    new_watermark = stats.select(F.col("new_watermark").alias("watermark_value"))
    return Load(merged, new_watermark, stats, unplaced)


def watermark_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], WATERMARK_SCHEMA)


def save_watermark(
    table: DataFrame, pipeline: str, value: DataFrame, updated_at: Column
) -> DataFrame:
    """The watermark table with the row of one pipeline set to a one-row frame's value."""
    row = value.select(
        F.lit(pipeline).alias("pipeline_name"),
        F.col("watermark_value").cast("timestamp").alias("watermark_value"),
        updated_at.cast("timestamp").alias("updated_at"),
    )
    return upsert(table, row, ["pipeline_name"])



def incremental_model(
    existing: DataFrame,
    source: DataFrame,
    date: str,
    build: Callable[[DataFrame], DataFrame],
    unique_key: Sequence[str],
    since: Any | None,
) -> DataFrame:
    """Rebuild the rows of an aggregate from ``since`` on and upsert them by unique key.

    The last built date is read again, so rows that reached it later are counted.
    """
    scope = source if since is None else source.where(F.col(date) >= F.lit(since))
    return upsert(existing, build(scope), unique_key)


def reconcile_late(
    target: DataFrame, full_source: DataFrame, keys: Sequence[str], date: str, day: Any
) -> DataFrame:
    """Upsert a whole day again, picking up rows that arrived after its first load."""
    return upsert(target, full_source.where(F.col(date) == F.lit(day)), keys)


def unprocessed(batches: DataFrame, processed: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows of batches that no earlier run has finished."""
    return batches.join(processed.select(batch).distinct(), batch, "left_anti")
