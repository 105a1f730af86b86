"""Slowly changing dimensions, types 1 to 4, and queries over their history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.merge import Insert, Update, merge
from lakeloom.operators.ordered import chunked_window, row_positions, top_n


def scd1(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    updated_at: Column | None = None,
) -> DataFrame:
    """Overwrite in place. ``updated_at`` stamps the rows that were updated or inserted."""
    if updated_at is not None:
        source = source.withColumn("updated_at", updated_at)
    chosen = None
    if update_columns is not None:
        stamped = [*update_columns] + (["updated_at"] if updated_at is not None else [])
        chosen = {c: f"src.{c}" for c in stamped}
    return merge(target, source, keys, [Update(set=chosen), Insert()])


def open_history(df: DataFrame, valid_from: Column) -> DataFrame:
    """A first version of every row."""
    start = valid_from.cast("timestamp")
    return df.withColumns(
        {
            "valid_from": start,
            "valid_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


def scd2(
    history: DataFrame,
    source: DataFrame,
    key: str,
    track: Sequence[str],
    effective: str,
    block: Column | None = None,
) -> DataFrame:
    """Full history: a changed tracked column closes the version before and opens a new one.

    ``source`` has the attribute columns of ``history`` plus ``effective`` (a timestamp) and
    may hold several versions of a key, late ones included. History and source are laid
    out on one time line per key, so the whole step is a union and one shuffle by key:

    * a source row equal to the version before it changes nothing if that version is still
      valid then, which also makes a second run of the same batch a no-op; a key that was
      closed and comes back opens a new version;
    * every version ends where the next begins, unless it had ended earlier;
    * a source row with the start time of an existing version replaces it.

    ``block`` (see :mod:`lakeloom.operators.ordered`; a function of ``valid_from``) is for
    keys with extremely many versions.
    """
    attributes = [c for c in history.columns if c not in ("valid_from", "valid_to", "is_current")]
    newest = [F.struct(*[c for c in attributes if c != key]).desc()]
    incoming = top_n(source.select(*attributes, effective), [key, effective], newest, 1).select(
        *attributes,
        F.col(effective).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(1).alias("_new"),
    )
    line = history.select(*attributes, "valid_from", "valid_to", F.lit(0).alias("_new")).unionByName(
        incoming
    )
    state = F.struct(*track)
    before = F.struct(state.alias("state"), F.col("valid_to").alias("ended"))
    order = [F.col("valid_from"), F.col("_new")]
    if block is None:
        w = Window.partitionBy(key).orderBy(*order)
        line = line.withColumn("_before", F.lag(before).over(w))
    else:
        line = row_positions(line, [key], order, block, "_pos")
        line = chunked_window(line, [key], {"_before": lambda w: F.lag(before).over(w)}, "_pos", 1)
    ended = F.coalesce(F.col("_before.ended") <= F.col("valid_from"), F.lit(False))
    same = F.col("_before").isNotNull() & state.eqNullSafe(F.col("_before.state")) & ~ended
    line = line.where((F.col("_new") == 0) | ~same).drop("_before")
    if block is None:
        line = line.withColumn("_next", F.lead("valid_from").over(w))
    else:
        line = row_positions(line.drop("_pos"), [key], order, block, "_pos")
        line = chunked_window(
            line, [key], {"_next": lambda w: F.lead("valid_from").over(w)}, "_pos", 0, 1
        )
    return (
        line.withColumn("valid_to", F.least("valid_to", "_next"))
        .where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
        .withColumn("is_current", F.col("valid_to").isNull())
        .select(*attributes, "valid_from", "valid_to", "is_current")
    )


def scd3(target: DataFrame, source: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Keep one earlier value of ``column`` in ``prev_<column>``."""
    previous = f"prev_{column}"
    if previous not in target.columns:
        kind = target.schema[column].dataType
        target = target.withColumn(previous, F.lit(None).cast(kind))
    changed = f"NOT (tgt.{column} <=> src.{column})"
    values = {c: f"src.{c}" for c in source.columns}
    return merge(
        target,
        source,
        keys,
        [Update(changed, {**values, previous: f"tgt.{column}"}), Update(set=values), Insert(values=values)],
    )


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current")).drop("valid_from", "valid_to", "is_current")


def closed_rows(history: DataFrame) -> DataFrame:
    return history.where(~F.col("is_current")).drop("is_current")


def scd4(
    history: DataFrame, source: DataFrame, key: str, track: Sequence[str], effective: str
) -> tuple[DataFrame, DataFrame]:
    """The current table and the separate table of closed versions."""
    done = scd2(history, source, key, track, effective)
    return current_rows(done), closed_rows(done)


def state_as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Versions valid at ``moment``, start inclusive and end exclusive."""
    at = moment.cast("timestamp")
    return history.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )
