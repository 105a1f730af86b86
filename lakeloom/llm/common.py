"""What several operators of this folder share: words, small-table joins, prefix sums."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A run of the characters between words, as a Java and as a Python pattern.
GAP = r"[\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; NULL text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def boxed(rows: DataFrame, **keys: Column) -> DataFrame:
    """All columns of the input in one struct ``row`` beside ``keys``, so that no name of the input can clash."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[k.alias(n) for n, k in keys.items()])


def unboxed(rows: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """The columns of the input out of ``row`` again, and ``more``."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns], *more)


def join_bounded(rows: DataFrame, small: DataFrame, condition: Column, limit: int, how: str = "left") -> DataFrame:
    """Join with a staged side: it is broadcast only if it has at most ``limit`` rows."""
    return rows.join(F.broadcast(small) if small.count() <= limit else small, condition, how)


def block_of(rows_in_key: Column, rows_per_block: int, *salt: Column) -> Column:
    """A block number that cuts a key of many rows into blocks of about ``rows_per_block``."""
    blocks = F.ceil(rows_in_key / F.lit(rows_per_block)).cast("bigint")
    return F.pmod(F.xxhash64(*salt), F.greatest(blocks, F.lit(1)))


def rows_per_block(df: DataFrame, total: int, least: int = 512) -> int:
    """A quarter of an even share of the rows for each shuffle partition."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(total / (4 * parts)))


def ordered_blocks(per_block: DataFrame, key: str, block: str, value: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the lower blocks of the same key.

    One row for each block goes in, never the rows themselves.
    """
    lower = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return per_block.withColumn("before", F.coalesce(F.sum(value).over(lower), F.lit(0)))
