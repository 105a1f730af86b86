"""Event-time windows, late data and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_watermark(stream: DataFrame, at: str, delay: str) -> DataFrame:
    """Declare lateness. Zone-less timestamps are read in the session zone first."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def windowed(
    stream: DataFrame,
    at: str,
    size: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    slide: str | None = None,
) -> DataFrame:
    """Tumbling windows, or sliding ones when ``slide`` is given."""
    window = F.window(at, size, slide) if slide else F.window(at, size)
    grouped = stream.groupBy(window.alias("w"), *keys).agg(*aggregates)
    rest = [c for c in grouped.columns if c != "w"]
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def sessions(
    stream: DataFrame, at: str, gap: str, keys: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Closed sessions per key: activity with pauses shorter than ``gap``.

    ``build_session`` has sessions merged inside each task before the shuffle, which shrinks
    busy keys.
    """
    grouped = stream.groupBy(F.session_window(at, gap).alias("s"), *keys).agg(*aggregates)
    rest = [c for c in grouped.columns if c != "s"]
    return grouped.select(F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), *rest)


def first_seen(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark; state stays bounded by it."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


# Window, slide and column names of the fleet's metrics.
FLEET_WINDOW = ("5 minutes", "1 minute")
FLEET_NAMES = {
    "mean": {"avg_speed": "speed_kmh", "avg_temp": "temperature_c"},
    "highest": {"max_speed": "speed_kmh"},
    "lowest": {"min_fuel": "fuel_level_pct"},
    "how_often": {"speed_violations": "is_speed_anomaly", "temp_alerts": "is_temp_anomaly"},
    "how_many": {"event_count": "device_id"},
    "latest": {"last_latitude": "latitude", "last_longitude": "longitude", "current_alert_level": "alert_level"},
}


def fleet_metrics(readings: DataFrame) -> DataFrame:
    """Sliding metrics per vehicle; the latest reading by event time is kept as one value."""
    size, slide = FLEET_WINDOW
    folds = {"mean": F.avg, "highest": F.max, "lowest": F.min, "how_often": F.count_if, "how_many": F.count}
    latest = FLEET_NAMES["latest"]
    measures = [fold(c).alias(name) for kind, fold in folds.items() for name, c in FLEET_NAMES[kind].items()]
    measures.append(F.max_by(F.struct(*[F.col(c).alias(name) for name, c in latest.items()]), "event_timestamp").alias("_latest"))
    rows = windowed(readings, "event_timestamp", size, ["vehicle_id"], measures, slide=slide)
    return rows.select("*", "_latest.*").drop("_latest")
