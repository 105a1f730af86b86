"""A streaming bronze -> silver -> gold pipeline with expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.streaming.windows import windowed, with_watermark

# The event types that are known.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def bronze(stream: DataFrame) -> DataFrame:
    """Raw events with lineage columns."""
    return stream.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source": F.lit("events")}
    )


def is_valid() -> "F.Column":
    return F.coalesce(
        F.col("event_id").isNotNull()
        & (F.col("value") > 0)
        & F.col("ts").isNotNull()
        & F.col("event_type").isin(*EVENT_TYPES),
        F.lit(False),
    )


def silver(raw: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Valid events, each id once."""
    typed = raw.where(is_valid()).withColumn("key", F.get_json_object("props", "$.k").try_cast("int"))
    return with_watermark(typed, "ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def quarantine(raw: DataFrame) -> DataFrame:
    """Everything silver refuses, with the reason."""
    reason = (
        F.when(F.col("event_id").isNull(), "NULL_ID")
        .when(F.col("ts").isNull(), "NULL_TIME")
        .when(F.col("value").isNull() | (F.col("value") <= 0), "INVALID_VALUE")
        .otherwise("UNKNOWN_TYPE")
    )
    return raw.where(~is_valid()).withColumn("quarantine_reason", reason)


def gold(clean: DataFrame) -> DataFrame:
    """Hourly totals per event type over closed hours."""
    return windowed(
        clean,
        "ts",
        "1 hour",
        ["event_type"],
        [
            F.count(F.lit(1)).alias("event_count"),
            F.sum("value").alias("total_value"),
            F.approx_count_distinct("user_id").alias("approx_users"),
        ],
    )
