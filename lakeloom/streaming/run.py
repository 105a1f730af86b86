"""Starting queries: sinks, triggers and checkpoints."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def _state_partitions(spark: SparkSession):
    """One state partition per core for the query started inside.

    A stream keeps its number of shuffle partitions for life and adaptive execution does
    not merge them, so the batch default fits neither small nor large clusters.
    """
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)


def start_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
    partition_by: tuple[str, ...] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Write a stream as Parquet. ``every`` such as ``"1 minute"`` keeps it running; without
    it, all data present now is processed in batches and the query ends."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with _state_partitions(stream.sparkSession):
        return writer.trigger(**trigger).start()


def start_batches(
    stream: DataFrame, handle, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Hand every micro-batch to ``handle(df, batch_id)``."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    with _state_partitions(stream.sparkSession):
        return writer.trigger(**trigger).start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an available-now query to end."""
    query.awaitTermination()
    return query
