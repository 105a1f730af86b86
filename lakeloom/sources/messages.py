"""Message-bus rows: connection options, decoding, encoding and bounded replay."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a message.
MESSAGE_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)


def stream_options(
    servers: str,
    topics: Sequence[str],
    starting: str = "latest",
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    group: str | None = None,
    protocol: str | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. The connector package must be on the cluster."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group:
        options["kafka.group.id"] = group
    if protocol:
        options["kafka.security.protocol"] = protocol
    return options


def offset_json(offsets: Mapping[str, Mapping[int, int]]) -> str:
    """Start or end offsets in the form the connector reads."""
    return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in offsets.items()})


def read_stream(spark: SparkSession, **options: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_range(
    spark: SparkSession, servers: str, topic: str, start: Mapping[int, int], end: Mapping[int, int] | None = None
) -> DataFrame:
    """Batch read of an offset range for backfills."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offset_json({topic: start}))
        .option("endingOffsets", offset_json({topic: end}) if end else "latest")
        .load()
    )


def within_offsets(
    messages: DataFrame, start: Mapping[int, int], end: Mapping[int, int]
) -> DataFrame:
    """Rows of messages already stored whose offset is in ``[start, end)`` of their partition."""
    inside = F.lit(False)
    for part, low in start.items():
        here = (F.col("partition") == part) & (F.col("offset") >= low)
        if part in end:
            here = here & (F.col("offset") < end[part])
        inside = inside | here
    return messages.where(inside)


def decode(messages: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The JSON value as columns, beside where the message came from."""
    return messages.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("message_timestamp"),
        F.from_json(F.col("value").cast("string"), schema).alias("event"),
    ).select("topic", "partition", "offset", "message_timestamp", "event.*")


def encode(df: DataFrame, key: str, columns: Sequence[Column | str]) -> DataFrame:
    """Key and JSON value, ready for a message sink."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value")
    )
