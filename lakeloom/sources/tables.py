"""Parquet writers and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    compression: str = "zstd",
    max_rows_per_file: int | None = None,
) -> None:
    """Append, overwrite or first write, optionally partitioned.

    Partitioned writes do not shuffle; cluster the frame by the partition columns first
    when it comes from many tasks and few files per partition matter.
    """
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, by: Sequence[str], path: str, sort_by: Sequence[str] = ()
) -> None:
    """A table whose rows are hashed by key, so joins on that key need no shuffle."""
    df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(
        buckets, *by
    ).sortBy(*(sort_by or by)).saveAsTable(table)


def save_external(df: DataFrame, table: str, path: str, mode: str = "overwrite") -> None:
    """A table whose files outlive ``DROP TABLE``."""
    df.write.mode(mode).format("parquet").option("path", path).saveAsTable(table)


def create_as(spark: SparkSession, table: str, query: str, path: str) -> DataFrame:
    """CREATE TABLE AS SELECT at a known location."""
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}' AS {query}")
    return spark.table(table)


def column_statistics(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    """Collect statistics for the cost-based optimizer."""
    scope = f"COLUMNS {', '.join(columns)}" if columns else "ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {scope}")
