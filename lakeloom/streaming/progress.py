"""Health figures of running queries."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "name string, batchId bigint, timestamp string, numInputRows bigint, "
    "inputRowsPerSecond double, processedRowsPerSecond double, "
    "durationMs map<string,bigint>, eventTime map<string,string>"
)


class ProgressLog(StreamingQueryListener):
    """Writes one line for every batch of every query to ``path``, ``group`` lines at a time.

    A query's own ``recentProgress`` forgets all but its last reports, so totals come from here.
    """

    def __init__(self, spark: SparkSession, path: str, group: int = 100):
        self.spark, self.path, self.group = spark, path, group
        self._lines: list[tuple[str]] = []

    def flush(self) -> None:
        lines, self._lines = self._lines, []
        if lines:
            self.spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._lines.append((event.progress.json,))
        if len(self._lines) >= self.group:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()


@contextmanager
def logged_progress(spark: SparkSession, path: str):
    """Log the progress of all queries that run inside to ``path``; complete on leaving."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(log)
        log.flush()


def progress_frame(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The logged reports as rows, of one query or of all."""
    rows = spark.read.text(path).select(F.from_json("value", SCHEMA).alias("p")).select("p.*")
    return rows.where(F.col("name") == name) if name else rows


def health(progress: DataFrame, now: Column, max_lag_minutes: float = 10, factor: float = 1.5) -> DataFrame:
    """Rates, batch duration, watermark lag, and flags for lag and growing backlog."""
    watermark = F.to_timestamp(F.col("eventTime")["watermark"])
    lag = (F.unix_seconds(now) - F.unix_seconds(watermark)) / 60
    return progress.select(
        "name",
        "batchId",
        "numInputRows",
        "inputRowsPerSecond",
        "processedRowsPerSecond",
        (F.col("durationMs")["triggerExecution"] / 1000).alias("batch_seconds"),
        F.round(lag, 1).alias("watermark_lag_min"),
        F.coalesce(lag > max_lag_minutes, F.lit(False)).alias("is_lagging"),
        F.coalesce(
            F.col("inputRowsPerSecond") > F.col("processedRowsPerSecond") * factor, F.lit(False)
        ).alias("is_backlogged"),
    )
