"""Joins beyond the built-in ones: point in time, skew-safe, size-checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and about the bytes of ``df``. Runs a job in which each task sends one row.

    Strings and binaries count by their length, arrays, maps and structs by that of their JSON
    text, other values by a fixed width.
    """

    def width_of(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(name), F.lit(0))
        if kind.startswith(("array<", "map<", "struct<")):
            return F.coalesce(F.octet_length(F.to_json(F.col(name))), F.lit(0))
        return F.lit(16)

    wide = [width_of(c, kind) for c, kind in df.dtypes]
    width = sum(wide[1:], wide[0]) if wide else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return row["rows"], row["bytes"]


def broadcast_if_small(
    df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 * 1024 * 1024
) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring it; otherwise return it unchanged.

    The unchanged frame joins by shuffle, where adaptive execution handles skew.
    """
    rows, size = measured_size(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: never more than ``1 / share`` of them."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("total"))
    return counts.where(F.col("rows") >= F.lit(share) * total.scalar())


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: Sequence[str],
    salts: int = 16,
    share: float = 0.01,
    how: str = "inner",
) -> DataFrame:
    """Equi-join that spreads the hot keys of ``left`` over ``salts`` pieces.

    The salt is a hash of ``row_id``, so a retried task assigns the same one again. Only
    the right rows of hot keys are repeated. ``how`` is inner, left or left_semi.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError("salting keeps the left side whole: inner, left or left_semi")
    # at most 1/share keys by construction, hence safe to broadcast
    hot = F.broadcast(
        hot_keys(left, key, share).select(F.col(key).alias("_hot_key"), F.lit(True).alias("_hot"))
    )
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    salted_left = (
        left.join(hot, left[key] == F.col("_hot_key"), "left")
        .withColumn(
            "_salt", F.when(is_hot, F.pmod(F.xxhash64(*row_id), F.lit(salts))).otherwise(0)
        )
        .drop("_hot_key", "_hot")
    )
    last_salt = F.when(is_hot, F.lit(salts - 1)).otherwise(0)
    salted_right = (
        right.join(hot, right[key] == F.col("_hot_key"), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last_salt)))
        .withColumn("_salt", F.col("_salt").cast("bigint"))
        .drop("_hot_key", "_hot")
    )
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def hot_split_join(
    left: DataFrame, right: DataFrame, key: str, share: float = 0.01, how: str = "inner"
) -> DataFrame:
    """Join hot keys and the rest in two plans and union the results by name.

    The right side of the hot plan holds only the hot keys, so adaptive execution turns
    that plan into a broadcast join when its measured size allows; otherwise both of its
    sides are large for these keys and adaptive execution splits them. Each right row goes
    to one of the two plans, so every join type gives what the plain join gives.
    """
    hot = F.broadcast(hot_keys(left, key, share).where(F.col(key).isNotNull()).select(key))
    left_hot, left_rest = left.join(hot, key, "left_semi"), left.join(hot, key, "left_anti")
    right_hot, right_rest = right.join(hot, key, "left_semi"), right.join(hot, key, "left_anti")
    return left_hot.join(right_hot, key, how).unionByName(left_rest.join(right_rest, key, how))


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    slice_days: int | None = None,
    horizon: Column | None = None,
    suffix: str = "",
) -> DataFrame:
    """Left join each fact to the version valid at its time: ``from <= at < to``.

    With ``slice_days`` versions are spread over the time slices they cover, so that a
    key with very many versions is matched slice by slice instead of version by version.
    Everything beyond ``horizon`` (a date) shares the last slice, which keeps open-ended
    versions finite and the result exact.

    History is broadcast only if it is small when measured, and never in slices: what it is
    made of, such as an explode, has rows that Spark's own estimate does not see.
    """
    renamed = history.select(
        F.col(key).alias("_h_key"),
        F.col(valid_from).alias("_h_from"),
        F.col(valid_to).alias("_h_to"),
        *[F.col(c).alias(f"{c}{suffix}") for c in columns],
    )
    inside = (
        (F.col(at) >= F.col("_h_from"))
        & (F.col("_h_to").isNull() | (F.col(at) < F.col("_h_to")))
        & (F.col(key) == F.col("_h_key"))
    )
    if slice_days is None:
        measured = broadcast_if_small(renamed)
        versions = measured if measured is not renamed else renamed.hint("merge")
        return facts.join(versions, inside, "left").drop("_h_key", "_h_from", "_h_to")
    if horizon is None:
        raise ValueError("slicing needs a horizon")

    def slice_of(moment: Column) -> Column:
        days = F.least(F.to_date(moment), F.to_date(horizon))
        return F.floor(F.unix_date(days) / slice_days)

    sliced_facts = facts.withColumn("_slice", slice_of(F.col(at)))
    sliced = renamed.withColumn(
        "_h_slice",
        F.explode(
            F.sequence(
                slice_of(F.col("_h_from")), slice_of(F.coalesce(F.col("_h_to"), horizon))
            )
        ),
    )
    same_slice = F.col("_slice") == F.col("_h_slice")
    matched = sliced_facts.join(sliced.hint("merge"), inside & same_slice, "left")
    return matched.drop("_h_key", "_h_from", "_h_to", "_h_slice", "_slice")
