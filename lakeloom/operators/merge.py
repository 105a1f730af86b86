"""MERGE as a lazy function of two DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.joins import measured_size
from lakeloom.operators.ordered import latest_per_key
from lakeloom.session import stage


@dataclass(frozen=True)
class Update:
    """WHEN MATCHED THEN UPDATE. ``set`` maps columns to SQL over ``tgt.`` and ``src.``;
    ``None`` takes every column the source has."""

    condition: str | None = None
    set: dict[str, str] | None = None


@dataclass(frozen=True)
class Delete:
    """WHEN MATCHED THEN DELETE."""

    condition: str | None = None


@dataclass(frozen=True)
class Insert:
    """WHEN NOT MATCHED THEN INSERT. ``values`` maps columns to SQL over ``src.``."""

    condition: str | None = None
    values: dict[str, str] | None = field(default=None)


Clause = Update | Delete | Insert


def _spread(df: DataFrame, on: Sequence[str]) -> Column:
    """A second join key that scatters rows with a NULL key, which match nothing anyway."""
    hashable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    any_null = F.lit(False)
    for c in on:
        any_null = any_null | F.col(c).isNull()
    return F.when(any_null, F.pmod(F.xxhash64(*hashable), F.lit(4096))).otherwise(F.lit(0))


def _pair(target: DataFrame, source: DataFrame, on: Sequence[str], small: bool) -> DataFrame:
    """Target and source rows side by side as structs ``tgt`` and ``src``."""
    # grouped and joined by the same columns as the merge itself, so that one shuffle of
    # the source serves all three
    spread = source.withColumn("_spread", _spread(source, on))
    place = [*on, "_spread"]
    counts = spread.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    duplicated = counts.where(F.col("_n") > 1).drop("_n").withColumn("_dup", F.lit(True))
    marked = spread.join(duplicated, place, "left")
    right = marked.select(
        *[F.col(c).alias(f"_s_{c}") for c in on],
        F.col("_spread").alias("_s_spread"),
        F.coalesce(F.col("_dup"), F.lit(False)).alias("_dup"),
        F.struct(*source.columns).alias("src"),
    )
    left = target.select(
        *[F.col(c).alias(f"_t_{c}") for c in on],
        _spread(target, on).alias("_t_spread"),
        F.struct(*target.columns).alias("tgt"),
    )
    condition = F.lit(True)
    for c in on:
        condition = condition & (F.col(f"_t_{c}") == F.col(f"_s_{c}"))
    if not small:
        condition = condition & (F.col("_t_spread") == F.col("_s_spread"))
        return left.join(right, condition, "full_outer").select("tgt", "src", "_dup")
    # the target is never shuffled: it is matched against a broadcast copy of the source,
    # and only its keys are read a second time to find the source rows to insert
    matched = left.join(F.broadcast(right), condition, "left").select("tgt", "src", "_dup")
    known = left.select(*[f"_t_{c}" for c in on]).join(
        F.broadcast(right.select(*[f"_s_{c}" for c in on])), condition, "left_semi"
    )
    fresh = right.join(known, condition, "left_anti").select(
        F.lit(None).cast(left.schema["tgt"].dataType).alias("tgt"), "src", "_dup"
    )
    return matched.unionByName(fresh)


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    clauses: Sequence[Clause],
    evolve: bool = False,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """The rows of the merged table plus ``_action``: kept, updated, deleted or inserted.

    Deleted rows are still present here; :func:`merge` removes them.
    """
    small = False
    if broadcast_rows is not None:
        rows, size = measured_size(source)
        small = rows <= broadcast_rows and size <= 64 * 1024 * 1024
    columns = list(target.columns)
    if evolve:
        columns += [c for c in source.columns if c not in columns]
    paired = _pair(target, source, on, small)
    matched = F.col("tgt").isNotNull() & F.col("src").isNotNull()
    fresh = F.col("tgt").isNull()

    step = F.when(F.lit(False), F.lit(-1))
    for i, clause in enumerate(clauses):
        applies = fresh if isinstance(clause, Insert) else matched
        if clause.condition:
            applies = applies & F.expr(clause.condition)
        step = step.when(applies, F.lit(i))
    action = F.lit("kept")
    for i, clause in enumerate(clauses):
        label = {Update: "updated", Delete: "deleted", Insert: "inserted"}[type(clause)]
        action = F.when(F.col("_step") == i, F.lit(label)).otherwise(action)

    rows = paired.withColumn("_step", step)
    ambiguous = F.col("_dup") & matched & F.col("_step").isNotNull()
    rows = rows.where(
        F.when(
            ambiguous,
            F.raise_error(F.lit("merge: several source rows match one target row")).cast("boolean"),
        ).otherwise(F.lit(True))
    ).where(F.col("tgt").isNotNull() | F.col("_step").isNotNull())

    types = {f.name: f.dataType for f in source.schema} | {f.name: f.dataType for f in target.schema}

    def value_of(column: str) -> Column:
        before = F.col("tgt")[column] if column in target.columns else F.lit(None)
        out = before
        for i, clause in enumerate(clauses):
            given = clause.values if isinstance(clause, Insert) else getattr(clause, "set", None)
            if isinstance(clause, Delete):
                continue
            if given is not None:
                if column in given:
                    new = F.expr(given[column])
                else:
                    new = F.lit(None) if isinstance(clause, Insert) else before
            elif column in source.columns:
                new = F.col("src")[column]
            else:
                new = F.lit(None) if isinstance(clause, Insert) else before
            out = F.when(F.col("_step") == i, new).otherwise(out)
        return out.cast(types[column]).alias(column)

    return rows.select(*[value_of(c) for c in columns], action.alias("_action"))


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    clauses: Sequence[Clause],
    evolve: bool = False,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """The target after MERGE, as a new DataFrame.

    Clauses are tried in order and the first that applies wins. NULL keys never match.
    The query fails when a changed target row has several source rows. ``broadcast_rows``
    measures the source first and, below that many rows, avoids shuffling the target.
    """
    done = merge_actions(target, source, on, clauses, evolve, broadcast_rows)
    return done.where(F.col("_action") != "deleted").drop("_action")


def upsert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    evolve: bool = False,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Update all columns of matching rows, insert the others."""
    return merge(target, source, on, [Update(), Insert()], evolve, broadcast_rows)


def upsert_latest(
    target: DataFrame, source: DataFrame, on: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Upsert after reducing the source to its newest row per key."""
    return upsert(target, latest_per_key(source, on, order), on)


def merge_partitions(
    path: str,
    source: DataFrame,
    on: Sequence[str],
    clauses: Sequence[Clause],
    partition: str,
) -> None:
    """MERGE into a partitioned Parquet folder, rewriting only partitions in the source.

    ``partition`` takes part in the match. The semi join on the partition column lets Spark
    skip all other folders; the new content is staged before the old is replaced.
    """
    spark = source.sparkSession
    touched = source.select(partition).distinct()
    target = spark.read.parquet(path).join(touched, partition, "left_semi")
    keys = [*on] if partition in on else [*on, partition]
    merged = merge(target, source, keys, clauses)
    replace_partitions(stage(merged, "merge"), path, partition)


def replace_partitions(df: DataFrame, path: str, *partition: str) -> None:
    """Overwrite just the partitions that ``df`` has rows for.

    Rows are rebalanced by partition: adaptive execution joins small partitions in a task and
    splits a crowded one by its size.
    """
    (
        df.hint("rebalance", *partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )
