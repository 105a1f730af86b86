"""Exact de-duplication by sorting the contents themselves.

Splitters sampled by Spark range-partition the rows by content, each partition is sorted
externally so that equal texts are neighbours, and neighbours are compared in full. The
splitter key is short whatever the length of a text (first characters, a 64-bit hash, a
hash of the identifier); the last part cuts a large group of copies over several
partitions. Groups that meet at a partition border are stitched from at most two rows for
each partition.

Defined results: NULL text counts as the empty text; NULL identifiers lose against all
others; of rows with equal text and equal identifier one stays; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import boxed, join_bounded, unboxed
from lakeloom.session import stage

LEAD_CHARS = 64
EMIT_ROWS = 20_000
#: Rows (of about 100 bytes) to take out of a table up to which they are broadcast.
BROADCAST_REMOVED = 300_000

_RUNS = (
    "doc_id bigint, text_sha256 string, run_keep bigint, run_size bigint, "
    "is_first boolean, at_border boolean, part int"
)


class _Output:
    """Collects rows of finished runs and cuts them into Arrow batches."""

    def __init__(self, part: int):
        self.part = part
        self.columns: list[list] = [[] for _ in range(6)]

    def add(self, ids: list, digest: str, border: bool) -> None:
        n = len(ids)
        self.columns[0] += ids
        self.columns[1] += [digest] * n
        self.columns[2] += [ids[0]] * n
        self.columns[3] += [n] * n
        self.columns[4] += [True] + [False] * (n - 1)
        self.columns[5] += [border] * n

    def flush(self, least: int) -> Iterator[pa.RecordBatch]:
        n = len(self.columns[0])
        if n and n >= least:
            ids, digests, keeps, sizes, firsts, borders = self.columns
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(keeps, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(firsts, pa.bool_()),
                    pa.array(borders, pa.bool_()),
                    pa.array([self.part] * n, pa.int32()),
                ],
                names=["doc_id", "text_sha256", "run_keep", "run_size", "is_first", "at_border", "part"],
            )
            self.columns = [[] for _ in range(6)]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition. Holds one text and one run's ids."""
    out = _Output(TaskContext.get().partitionId())
    body, ids, first_run = None, [], True
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and text == body:
                ids.append(doc_id)
                continue
            if ids:
                out.add(ids, hashlib.sha256(body).hexdigest(), first_run)
                first_run = False
            body, ids = text, [doc_id]
        yield from out.flush(EMIT_ROWS)
    if ids:
        out.add(ids, hashlib.sha256(body).hexdigest(), True)
    yield from out.flush(1)


def content_sort_dedup(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per document: which row of its group of equal texts stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. ``keep`` names the
    identifier that stays: ``smallest`` or ``largest``.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    body = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        body.cast("binary").alias("body"),
        F.substring(body, 1, LEAD_CHARS).alias("lead"),
        F.xxhash64(body).alias("print"),
        F.xxhash64("doc_id").alias("spread"),
    )
    best = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    by_content = keyed.repartitionByRange("lead", "print", "spread").sortWithinPartitions("lead", "print", "body", best)
    runs = stage(by_content.select("doc_id", "body").mapInArrow(_neighbours, _RUNS), "content-runs")
    # At most two runs of a partition touch its borders, so this table is bounded by the
    # number of partitions.
    winner = F.max("run_keep") if keep == "largest" else F.min("run_keep")
    borders = (
        runs.where("at_border AND is_first")
        .groupBy(F.col("text_sha256").alias("sha"))
        .agg(winner.alias("all_keep"), F.sum("run_size").alias("all_size"), F.count("*").alias("n_runs"))
        .where("n_runs > 1")
        .drop("n_runs")
    )
    joined = runs.join(F.broadcast(borders), F.col("text_sha256") == F.col("sha"), "left")
    keep_id = F.coalesce("all_keep", "run_keep")
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("is_first") & F.col("run_keep").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs``, all columns, that stay; of rows equal in identifier and text one does."""
    verdict = stage(content_sort_dedup(docs, keep).where("NOT kept"), "copies")
    own = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    names = [F.col("doc_id").alias("c_id"), F.col("text_sha256").alias("c_mark")]
    mark = F.sha2(F.coalesce("text", F.lit("")), 256)
    return remove_marked(docs, mark, verdict.where(~own).select(*names), verdict.where(own).select(*names))


def remove_marked(docs: DataFrame, mark: Column, removed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` without the rows ``removed (c_id, c_mark)`` and with one of each in ``repeated``."""
    marked = boxed(docs, own_id=F.col("doc_id"), own_mark=mark)
    same = F.col("own_id").eqNullSafe(F.col("c_id")) & (F.col("own_mark") == F.col("c_mark"))
    repeated = stage(repeated.distinct(), "repeated")
    gone = stage(removed.distinct().union(repeated), "removed")
    kept = join_bounded(marked, gone, same, BROADCAST_REMOVED, "left_anti")
    if not repeated.isEmpty():
        again = join_bounded(marked, repeated, same, BROADCAST_REMOVED, "left_semi")
        kept = kept.union(again.dropDuplicates(["own_id", "own_mark"]))
    return unboxed(kept, docs.columns)
