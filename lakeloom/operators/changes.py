"""Change feeds between snapshots, replay, restore and change-driven aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.ordered import top_n
from lakeloom.session import stage

META = ["_change_type", "_commit_version", "_commit_timestamp"]


def change_feed(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    version: int,
    committed_at: Column,
) -> DataFrame:
    """Rows that turn ``before`` into ``after``: insert, delete, update_pre/postimage.

    Both frames have the same columns and unique, non-NULL keys. Values are compared so
    that NULL equals NULL.
    """
    columns = after.columns
    old = before.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*columns).alias("_old")
    )
    new = after.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.struct(*columns).alias("_new"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"_o_{k}") == F.col(f"_n_{k}"))
    pairs = old.join(new, condition, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))

    def tagged(kind: str, row: str) -> Column:
        return F.when(
            F.col(row).isNotNull(), F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))
        )

    is_update = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    images = F.when(
        is_update, F.array(tagged("update_preimage", "_old"), tagged("update_postimage", "_new"))
    ).otherwise(F.array_compact(F.array(tagged("delete", "_old"), tagged("insert", "_new"))))
    return (
        pairs.select(F.explode(images).alias("_c"))
        .select("_c.row.*", F.col("_c.kind").alias("_change_type"))
        .withColumn("_commit_version", F.lit(version).cast("bigint"))
        .withColumn("_commit_timestamp", committed_at.cast("timestamp"))
    )


def bucket_digests(df: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """``bucket, digest``: rows hashed by key into buckets, each with a digest of its rows.

    The digest does not depend on the order of rows: their number, and the exclusive or and
    the sum of two hashes of each. It is combined within tasks, so one row per bucket and
    task is shuffled.
    """
    columns = sorted(df.columns)
    row = F.xxhash64(*columns)
    other = F.pmod(F.xxhash64(F.lit(1), *columns), F.lit(2**40))
    parts = df.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), row.alias("x"), other.alias("s"))
    return parts.groupBy("bucket").agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.bit_xor("x").alias("x"), F.sum("s").alias("s")).alias("digest")
    )


def differing_buckets(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """Buckets whose rows are not the same in both versions; at most ``buckets`` rows."""
    old = bucket_digests(before, keys, buckets).withColumnRenamed("digest", "old_digest")
    new = bucket_digests(after.select(*before.columns), keys, buckets).withColumnRenamed("digest", "new_digest")
    both = old.join(new, "bucket", "full_outer")
    return both.where(~F.col("old_digest").eqNullSafe(F.col("new_digest"))).select("bucket")


def compare_versions(
    before: DataFrame, after: DataFrame, keys: Sequence[str], version: int, committed_at: Column, buckets: int = 4096
) -> DataFrame:
    """:func:`change_feed` of two stored versions, joined only where bucket digests differ.

    Both are read once for the digests; of two equal versions nothing else is shuffled.
    """
    differing = stage(differing_buckets(before, after, keys, buckets), "differing")
    own = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def only(df: DataFrame) -> DataFrame:
        marked = df.withColumn("_bucket", own)
        return marked.join(F.broadcast(differing), F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket")

    return change_feed(only(before), only(after.select(*before.columns)), keys, version, committed_at)


def initial_feed(df: DataFrame, version: int, committed_at: Column) -> DataFrame:
    """Every row as an insert, the first commit of a log."""
    return (
        df.withColumn("_change_type", F.lit("insert"))
        .withColumn("_commit_version", F.lit(version).cast("bigint"))
        .withColumn("_commit_timestamp", committed_at.cast("timestamp"))
    )


def changes_between(
    log: DataFrame,
    start_version: int | None = None,
    end_version: int | None = None,
    start_time: Column | None = None,
    end_time: Column | None = None,
) -> DataFrame:
    """Part of a change log, bounds inclusive."""
    out = log
    if start_version is not None:
        out = out.where(F.col("_commit_version") >= start_version)
    if end_version is not None:
        out = out.where(F.col("_commit_version") <= end_version)
    if start_time is not None:
        out = out.where(F.col("_commit_timestamp") >= start_time)
    if end_time is not None:
        out = out.where(F.col("_commit_timestamp") <= end_time)
    return out


def replay(
    log: DataFrame,
    keys: Sequence[str],
    version: int | None = None,
    at: Column | None = None,
) -> DataFrame:
    """The table as of a version or a moment: the newest image per key, deletes removed."""
    upto = changes_between(log, end_version=version, end_time=at)
    images = upto.where(F.col("_change_type") != "update_preimage")
    newest = top_n(images, keys, [F.col("_commit_version").desc()], 1)
    return newest.where(F.col("_change_type") != "delete").drop(*META)


def recover_deleted(
    current: DataFrame, log: DataFrame, keys: Sequence[str], version: int
) -> DataFrame:
    """The current table plus the rows of an older version whose keys are gone."""
    lost = replay(log, keys, version).join(current.select(*keys), list(keys), "left_anti")
    return current.unionByName(lost)


def change_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("_commit_version", "_change_type").agg(F.count(F.lit(1)).alias("rows"))


def touched_keys(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with any change, deletes and both sides of updates included."""
    return feed.select(*keys).distinct()


def refresh_aggregate(
    gold: DataFrame,
    silver: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
) -> DataFrame:
    """Recompute only the groups a change feed touches; groups left empty disappear."""
    touched = touched_keys(feed, keys)
    fresh = silver.join(touched, list(keys), "left_semi").groupBy(*keys).agg(*aggregates)
    return gold.join(touched, list(keys), "left_anti").unionByName(fresh)


def difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key ``right`` does not have."""
    return left.join(right.select(*keys), list(keys), "left_anti")
