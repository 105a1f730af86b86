"""Mixing sources to target weights with a curriculum that changes over training time.

Each source has a weight schedule over training time 0..1. Its integral up to ``t`` is the
share of the source's tokens that training has asked for by then. A document stands at a
place in its source's token stream; inverting the cumulative demand at that place gives the
training position, and documents are range-sorted by position.

The stream of a source is its documents in the order of a hash, repeated until the target is
reached; the last document of the stream is cut at a word, so a source's taken words are its
target rounded down.

Defined results: NULL text has size 0 and is never taken; a NULL source is a source of its
own, last in order; a source without words has target 0; equal rows are interchangeable; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import boxed, join_bounded, ordered_blocks, rows_per_block, unboxed, words
from lakeloom.session import stage

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Linear schedules by weight: the factor on the mean weight at the start of training; at the
#: end it is 2 minus that, so that the integral over training is the target.
START_FACTORS = (1.5, 1.0, 0.5)
#: Rows of the table of sources up to which it is broadcast (about 100 bytes a row).
BROADCAST_SOURCES = 50_000


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of sources ``(source, source_size)``, one row each, by water filling.

    All sizes are shared by weight; a source whose share is above ``max_repeats`` times its
    size stops there and the excess goes to the others by weight. Sorted by the level at
    which they stop, sources fill up one after the other, so one running sum finds the
    final level without repeated sharing. Windows here see one row for each source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    level = Window.orderBy(F.col("stops_at"), F.col("rank")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("rank", F.row_number().over(ordered) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("stops_at", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(level), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(level), F.lit(0)))
        .withColumn(
            "level", (F.col("total") - F.col("cap_before")) / (F.col("all_weights") - F.col("weight_before"))
        )
    )
    # The first source whose level lies within its stop sets the level of all later ones.
    final = F.min(F.when(F.col("level") <= F.col("stops_at"), F.struct("stops_at", "rank", "level"))).over(everything)
    return (
        ranked.withColumn("final", final["level"])
        .withColumn(
            "target",
            F.coalesce(
                F.least(F.col("final") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double")
            ),
        )
        .select("source", "source_size", "rank", "weight", "target")
    )


def demand_inverse(share: Column, start: Column) -> Column:
    """Training time at which ``share`` of a source's tokens has been asked for.

    The schedule falls linearly from ``start`` to ``2 - start`` times the mean, so the demand
    is ``start * t - (start - 1) * t^2``; this is its inverse in a form without cancellation.
    """
    root = F.sqrt(F.greatest(start * start - (start - 1) * share * 4, F.lit(0.0)))
    return F.least(share * 2 / (start + root), F.lit(1.0))


def plan(docs: DataFrame, *carry: str) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target, whole, cut, taken, first_position``.

    ``whole`` copies of the document are taken in full and one of ``cut`` words more;
    ``taken`` is the sum in words and ``first_position`` the earliest training time.
    Columns named in ``carry`` come along.
    """
    slim = stage(
        docs.select(
            F.col("doc_id"),
            F.col("source"),
            F.size(words("text")).cast("bigint").alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place"),
            *carry,
        ),
        "mix-sizes",
    )
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    sizes = stage(sizes, "mix-sources")
    planned = targets(sizes.select("source", "source_size"))
    starts = F.element_at(F.array(*map(F.lit, START_FACTORS)), (F.col("weight") - 1).cast("int") % len(START_FACTORS) + 1)
    sources = stage(
        planned.withColumn("start", starts)
        .join(sizes.select(F.col("source").alias("s"), "source_rows"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumnRenamed("source", "of"),
        "mix-targets",
    )
    total = sources.agg(F.sum("source_rows")).first()[0] or 0
    rows = join_bounded(slim, sources, F.col("source").eqNullSafe(F.col("of")), BROADCAST_SOURCES, "inner")

    # Running size in the order of ``place``, without one task for a source: the first digits
    # of ``place`` cut a source into blocks, whose sums are added up apart.
    digits = F.conv(F.substring("place", 1, 12), 16, 10).cast("bigint")
    blocks = F.greatest(F.ceil(F.col("source_rows") / rows_per_block(slim, total)), F.lit(1)).cast("bigint")
    rows = rows.withColumn("block", F.floor(digits / F.lit(float(16**12)) * blocks).cast("bigint"))
    sums = ordered_blocks(rows.groupBy("rank", "block").agg(F.sum("size").alias("of_block")), "rank", "block", "of_block")
    sums = sums.select(F.col("rank").alias("r"), F.col("block").alias("b"), "before")
    inside = Window.partitionBy("rank", "block").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, (F.col("rank") == F.col("r")) & (F.col("block") == F.col("b"))).withColumn(
        "at", F.col("before") + F.col("within")
    )

    wanted = F.floor("target").cast("bigint")
    has = F.col("source_size") > 0
    rounds = F.when(has, F.expr("CAST(floor(target) AS BIGINT) div source_size")).otherwise(F.lit(0)).cast("bigint")
    rest = wanted - rounds * F.col("source_size")
    part = F.when(has, F.greatest(F.least(rest - F.col("at"), F.col("size")), F.lit(0))).otherwise(F.lit(0))
    rows = rows.withColumn("rounds", rounds).withColumn("part", part.cast("bigint"))
    filled = (F.col("part") == F.col("size")) & (F.col("size") > 0)
    taken = F.col("rounds") * F.col("size") + F.col("part")
    return rows.select(
        "doc_id",
        "size",
        "source",
        "source_size",
        "target",
        F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("rounds") + filled.cast("bigint")).cast("bigint").alias("whole"),
        F.when(filled, F.lit(0)).otherwise(F.col("part")).cast("bigint").alias("cut"),
        taken.cast("bigint").alias("taken"),
        F.when(taken > 0, position("at", F.lit(0))).alias("first_position"),
        "at",
        "start",
        *carry,
    )


def position(at: str, copy: Column) -> Column:
    """Training time of the copy numbered ``copy`` of the document at ``at`` in its source."""
    middle = F.col(at) + copy * F.col("source_size") + F.least(F.col("size"), F.col("target")) / 2
    return demand_inverse(F.least(middle / F.col("target"), F.lit(1.0)), F.col("start"))


def by_position(planned: DataFrame) -> DataFrame:
    """Documents range-sorted by training position; what is never taken stands last."""
    key = F.coalesce("first_position", F.lit(2.0))
    return planned.repartitionByRange(key, "doc_id").sortWithinPartitions(key, "doc_id")


def _cut(cut_to: str):
    """Shortens ``text`` to as many first words as the column ``cut_to`` says, where that is set."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, n in enumerate(batch.column(cut_to).to_pylist()):
                if n:
                    ends = (m.end() for k, m in enumerate(word.finditer(texts[i]), 1) if k == n)
                    texts[i] = texts[i][: next(ends, len(texts[i]))]
            where = batch.schema.get_field_index("text")
            yield batch.set_column(where, batch.schema.field(where), pa.array(texts, batch.schema.field(where).type))

    return shorten


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: a row for each taken copy, in training order, with the columns of ``docs``.

    Rows equal in every column are told apart by nothing and count as copies of one row.
    """
    columns = docs.columns
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    planned = plan(docs.select("doc_id", "source", "text", mark.alias("mark")), "mark").where("taken > 0")
    copies = planned.select(
        F.col("doc_id").alias("id"),
        F.col("mark").alias("of"),
        "at", "size", "source_size", "target", "start", "whole", "cut",
        F.explode(F.sequence(F.lit(0), (F.col("whole") + (F.col("cut") > 0).cast("int") - 1).cast("int"))).alias("copy"),
    )
    placed = copies.select(
        "id", "of",
        position("at", F.col("copy")).alias("position"),
        F.when(F.col("copy") == F.col("whole"), F.col("cut")).alias("cut_to"),
    )
    once = boxed(docs, own_id=F.col("doc_id"), own_mark=mark).dropDuplicates(["own_id", "own_mark"])
    joined = placed.join(once, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("of") == F.col("own_mark")))
    joined = joined.repartitionByRange("position", "id").sortWithinPartitions("position", "id")
    cut_to = "cut_to"
    while cut_to in columns:
        cut_to = "_" + cut_to
    kept = unboxed(joined, columns, F.col("cut_to").alias(cut_to))
    return kept.mapInArrow(_cut(cut_to), kept.schema).select(*[F.col(f"`{c}`") for c in columns])
