"""Exact histogram of encoded lengths, and what its running sums answer.

Documents are encoded where they lie; only their lengths are counted. From then on everything
is a table of one row for each length that occurs, at most the longest document's length, and
its suffix sums give totals, quantiles and truncated totals for every context limit.

Defined results: NULL and empty texts have length 0; repeated rows count each; an empty table
gives an empty histogram; other columns are not looked at. Texts that spell a special token
are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import ordered_blocks
from lakeloom.session import stage

#: Lengths that one task sums up in order.
BLOCK = 1024
_encodings: dict[str, object] = {}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoding(path: str):
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def _lengths(path: str):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path).encode_ordinary
        for batch in batches:
            lengths = [len(encode(t)) if t else 0 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], names=["length"])

    return measure


def histogram(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``length, documents`` for every encoded length that occurs."""
    lengths = docs.select("text").mapInArrow(_lengths(ranks or default_ranks()), "length bigint")
    return lengths.groupBy("length").agg(F.count("*").alias("documents"))


def with_sums(counted: DataFrame) -> DataFrame:
    """Each length as a context limit, with the sums over shorter and longer documents.

    Adds ``tokens`` (in documents of this length), ``documents_below``, ``documents_from``
    (this long or longer), ``total_tokens`` and ``truncated_tokens`` (what is left of the
    corpus when every document is cut at this length).
    """
    counted = stage(counted, "histogram").withColumns(
        {"tokens": F.col("length") * F.col("documents"), "block": F.floor(F.col("length") / BLOCK), "all": F.lit(0)}
    )
    blocks = counted.groupBy("all", "block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    docs_before = ordered_blocks(blocks, "all", "block", "d").withColumnRenamed("before", "docs_before")
    before = ordered_blocks(docs_before, "all", "block", "t").withColumnRenamed("before", "tokens_before")
    before = before.select(F.col("block").alias("b"), "docs_before", "tokens_before")
    lower = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    below = lambda name: F.coalesce(F.sum(name).over(lower), F.lit(0))
    total = counted.agg(F.sum("documents").alias("all_documents"), F.sum("tokens").alias("total_tokens"))
    rows = counted.withColumns({"d_in": below("documents"), "t_in": below("tokens")})
    rows = rows.join(F.broadcast(before), F.col("block") == F.col("b")).join(F.broadcast(total), F.lit(True))
    rows = rows.withColumns(
        {
            "documents_below": F.col("docs_before") + F.col("d_in"),
            "tokens_below": F.col("tokens_before") + F.col("t_in"),
        }
    ).withColumn("documents_from", F.col("all_documents") - F.col("documents_below"))
    return rows.select(
        "length",
        "documents",
        "tokens",
        "documents_below",
        "documents_from",
        "tokens_below",
        "total_tokens",
        (F.col("tokens_below") + F.col("length") * F.col("documents_from")).alias("truncated_tokens"),
    )


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context_limit, truncated_tokens`` for any limits, those between two lengths too."""
    wanted = F.explode(F.array(*[F.lit(int(n)).cast("bigint") for n in limits]))
    rows = sums.select("length", "documents", "tokens", wanted.alias("context_limit"))
    cut = F.sum(F.when(F.col("length") <= F.col("context_limit"), F.col("tokens")).otherwise(F.col("context_limit") * F.col("documents")))
    return rows.groupBy("context_limit").agg(cut.alias("truncated_tokens"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, length``: the smallest length that at least this share of documents doesn't exceed."""
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    rows = sums.select(
        "length", (F.col("documents_below") + F.col("documents")).alias("upto"),
        (F.col("documents_below") + F.col("documents_from")).alias("every"), wanted.alias("share"),
    )
    return rows.where(F.col("upto") >= F.col("share") * F.col("every")).groupBy("share").agg(F.min("length").alias("length"))
