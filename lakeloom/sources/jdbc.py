"""Relational databases over JDBC.

The catalogue has no query for these: it would need a database to talk to.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int = 8,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A table, read by ``partitions`` parallel range queries when a column is given.

    The bounds only shape the ranges; rows outside them are read too.
    """
    made = read_options(url, table, partition_column, lower, upper, partitions, fetch_size)
    return spark.read.format("jdbc").options(**made, **options).load()


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int = 8,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    made = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        made |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return made


def since_query(table: str, column: str, watermark: str | None) -> str:
    """The sub-query of an incremental read."""
    where = "" if watermark is None else f" WHERE {column} >= {watermark}"
    return f"(SELECT * FROM {table}{where}) src"


def read_since(
    spark: SparkSession, url: str, table: str, column: str, watermark: str | None, **more: Any
) -> DataFrame:
    """Rows at or after a watermark, filtered inside the database.

    ``watermark`` is a SQL literal of the database, written by the caller.
    """
    return read_table(spark, url, since_query(table, column, watermark), **more)


def write_table(
    df: DataFrame, url: str, table: str, replace: bool = False, batch_size: int = 10_000, **options: str
) -> None:
    """Append, or empty the table and load it again while keeping its definition."""
    (
        df.write.format("jdbc")
        .mode("overwrite" if replace else "append")
        .options(url=url, dbtable=table, batchsize=str(batch_size), truncate=str(replace).lower(), **options)
        .save()
    )
