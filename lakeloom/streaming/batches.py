"""Micro-batch handlers for sinks without transactions.

Each batch writes to its own ``batch_id=`` folder and overwrites it when replayed, so a
batch that failed half-way or ran twice leaves the same result. The table itself is the
newest row per key over all batches; nothing is rewritten while the stream runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.ordered import latest_per_key
from lakeloom.session import stage

Handler = Callable[[DataFrame, int], None]


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def append_handler(path: str) -> Handler:
    """Store every batch, replay-safe."""

    def handle(df: DataFrame, batch_id: int) -> None:
        write_batch(df, path, batch_id)

    return handle


def upsert_handler(path: str, keys: Sequence[str], order: Sequence[Column]) -> Handler:
    """Store the newest row per key of every batch; read back with :func:`current_rows`."""

    def handle(df: DataFrame, batch_id: int) -> None:
        write_batch(latest_per_key(df, keys, order), path, batch_id)

    return handle


def current_rows(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """The upserted table: newest row per key, later batches winning over ``order`` ties."""
    rows = spark.read.parquet(path)
    return latest_per_key(rows, keys, [*order, F.col("batch_id").desc()]).drop("batch_id")


def fold_batches(
    spark: SparkSession, path: str, keys: Sequence[str], upto: int, order: Sequence[Column] = ()
) -> None:
    """Fold all batches up to ``upto`` into its folder, newest row per key.

    A base for later reads, so the table does not grow with the number of batches. ``upto``
    must be a batch that the stream has committed: it is not replayed any more. Safe to
    repeat: until the older folders are gone their rows lose against those of the base.
    """
    older = spark.read.parquet(path).where(F.col("batch_id") <= upto)
    newest = latest_per_key(older, keys, [*order, F.col("batch_id").desc()]).drop("batch_id")
    write_batch(stage(newest, "fold"), path, upto)
    done = spark.read.parquet(path).select("batch_id").where(F.col("batch_id") < upto).distinct()
    for row in done.toLocalIterator():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={row.batch_id}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def multi_sink_handler(sinks: dict[str, Callable[[DataFrame], DataFrame]]) -> Handler:
    """Several outputs from one batch that is computed once: ``{path: transform}``."""

    def handle(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for path, transform in sinks.items():
                write_batch(transform(df), path, batch_id)
        finally:
            df.unpersist()

    return handle

