"""Joins between streams, and between a stream and a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.streaming.batches import write_batch


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_at: str,
    right_at: str,
    within: str,
    how: str = "inner",
    salts: int = 1,
) -> DataFrame:
    """Match when the right event follows the left one by at most ``within``.

    Both sides carry a watermark and share no column names. Adaptive execution does not
    split skewed keys of a stream, so for busy keys each left row takes one of ``salts``
    places (by a hash of the row) and each right row stands in all of them. ``how`` is
    inner or left.
    """
    start = F.col(left_at)
    matches = (
        (F.col(left_key) == F.col(right_key))
        & (F.col(right_at) >= start)
        & (F.col(right_at) <= start + F.expr(f"interval {within}"))
    )
    if salts == 1:
        return left.join(right, matches, how)
    salted = left.withColumn("_ls", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    places = right.withColumn("_rs", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return salted.join(places, matches & (F.col("_ls") == F.col("_rs")), how).drop("_ls", "_rs")


def unmatched(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_at: str,
    right_at: str,
    within: str,
    salts: int = 1,
) -> DataFrame:
    """Left events that no right event answered in time.

    An anti join of two streams is not allowed, so this is the NULL side of an outer join;
    a row appears once the watermark has passed its interval.
    """
    keep = left.columns
    joined = interval_join(left, right, left_key, right_key, left_at, right_at, within, "left", salts)
    return joined.where(F.col(right_key).isNull()).select(*keep)


def enrich(stream: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Add the columns of a table to a stream; the table is read anew for each batch."""
    return stream.join(table, key, "left")


def enrich_hot(stream: DataFrame, table: DataFrame, key: str, hot: Sequence, salts: int) -> DataFrame:
    """:func:`enrich` with the rows of ``hot`` keys dealt over ``salts`` places each.

    The table's rows of these keys stand in all places, all others in the first.
    """
    if not hot:
        return enrich(stream, table, key)
    is_hot = F.coalesce(F.col(key).isin(*hot), F.lit(False))
    place = F.pmod(F.xxhash64(*stream.columns), F.lit(salts)).cast("int")
    salted = stream.withColumn("_salt", F.when(is_hot, place).otherwise(F.lit(0)))
    everywhere = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(table.withColumn("_salt", F.explode(everywhere)), [key, "_salt"], "left").drop("_salt")


@dataclass(frozen=True)
class HotEnrichment:
    """Stream-static join as a handler that learns which keys are hot.

    Adaptive execution does not split the joins of a stream. Keys above ``share`` of a batch,
    hence fewer than ``1 / share``, are stored below ``state`` under the batch's number, and the
    batch after it replicates the table's rows of them. A replayed batch reads what the batch
    before it stored, so it repeats its work. Only the first batch is counted ahead.
    """

    path: str
    state: str
    table: DataFrame
    key: str
    share: float = 0.02
    salts_per_partition: int = 4

    def hot_keys(self, df: DataFrame) -> DataFrame:
        counts = df.groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).where(F.col(self.key).isNotNull())
        total = df.agg((F.count(F.lit(1)) * self.share).alias("least"))
        return counts.join(F.broadcast(total), F.col("n") > F.col("least")).select(F.col(self.key).alias("key"), "n")

    def _known(self, df: DataFrame, batch_id: int) -> list:
        """At most ``1 / share`` keys."""
        spark = df.sparkSession
        if batch_id == 0:
            stored = self.hot_keys(df)
        else:
            stored = spark.read.parquet(f"{self.state}/batch_id={batch_id - 1}")
        return stored.agg(F.sort_array(F.collect_list("key"))).first()[0]

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        hot = self._known(df, batch_id)
        salts = self.salts_per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
        write_batch(enrich_hot(df, self.table, self.key, hot, salts), self.path, batch_id)
        write_batch(self.hot_keys(df).coalesce(1), self.state, batch_id)


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """One stream from several, tagged with ``_source``; columns a source lacks are NULL."""
    out = None
    for name, df in sources.items():
        tagged = df.withColumn("_source", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
