"""Column masks, row filters and personal-data inventory."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.masking import PII_PATTERNS, PII_SIGNS
from lakeloom.session import stage


@dataclass(frozen=True)
class Policy:
    """``masks``: column -> (groups that see it in clear, masked form).
    ``row_filters``: group -> SQL predicate; a reader sees the rows of all their groups."""

    masks: Mapping[str, tuple[Collection[str], Column]] = field(default_factory=dict)
    row_filters: Mapping[str, str] = field(default_factory=dict)


def secure_view(df: DataFrame, policy: Policy, groups: Collection[str]) -> DataFrame:
    """What a member of ``groups`` may see. No matching group means no rows."""
    out = df
    if policy.row_filters:
        allowed = F.lit(False)
        for group, predicate in policy.row_filters.items():
            if group in groups:
                allowed = allowed | F.coalesce(F.expr(predicate), F.lit(False))
        out = out.where(allowed)
    hidden = {
        column: mask
        for column, (clear, mask) in policy.masks.items()
        if not set(clear) & set(groups)
    }
    return out.withColumns(hidden) if hidden else out


def pii_scan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Matches of every pattern in every text column, over whole texts and in one pass."""

    def hits(c: str, kind: str) -> Column:
        # a cheap look for a character every match must have spares most of the scanning
        found = F.regexp_count(c, F.lit(PII_PATTERNS[kind]))
        sign = PII_SIGNS[kind]
        return F.when(F.col(c).contains(sign), found).otherwise(0) if sign else found

    pairs = [(c, kind) for c in columns for kind in PII_PATTERNS]
    found = df.select(*[hits(c, kind).alias(f"{c}|{kind}") for c, kind in pairs])
    counted = found.agg(
        *[
            F.struct(
                F.coalesce(F.sum(F.col(f"`{c}|{kind}`")), F.lit(0)).alias("matches"),
                F.count(F.when(F.col(f"`{c}|{kind}`") > 0, F.lit(1))).alias("rows_hit"),
            ).alias(f"{c}|{kind}")
            for c, kind in pairs
        ]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kind).alias("pii_type"),
                F.col(f"`{c}|{kind}`.matches").alias("matches"),
                F.col(f"`{c}|{kind}`.rows_hit").alias("rows_hit"),
            )
            for c in columns
            for kind in PII_PATTERNS
        ]
    )
    return counted.select(F.inline(lines))


def tagged_columns(tags: DataFrame, name: str = "pii", value: str = "true") -> DataFrame:
    """Columns that carry a tag, from ``table_name, column_name, tag_name, tag_value``."""
    return tags.where((F.col("tag_name") == name) & (F.col("tag_value") == value)).select(
        "table_name", "column_name"
    )


def erase(
    layers: Mapping[str, DataFrame], key: str, requests: DataFrame
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Remove the requested keys from every layer; also a log of the rows removed."""
    ids = requests.select(key).distinct()
    kept = {name: df.join(ids, key, "left_anti") for name, df in layers.items()}
    log = None
    for name, df in layers.items():
        line = df.join(ids, key, "left_semi").agg(
            F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows_deleted")
        )
        log = line if log is None else log.unionByName(line)
    return kept, log


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def erase_files(spark: SparkSession, path: str, key: str, requests: DataFrame, run: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Remove the requested keys from a stored table by rewriting only the files that hold them.

    Returns the deletion log ``file_path, rows_deleted``, which stays below ``_erasure/<run>``.
    First the log and the new files are written there, out of the table's sight, then
    :func:`finish_erasure` swaps them in. A run that broke off is finished by the same call:
    what is already written is not made again, since the old files may be gone by then.
    """
    work = f"{path}/_erasure/{run}"
    ready, fs = _files(spark, f"{work}/files/_SUCCESS")
    if not fs.exists(ready):
        ids = stage(requests.select(key).where(F.col(key).isNotNull()).distinct(), "erasure-ids")
        rows = spark.read.parquet(path).select(key, F.col("_metadata.file_path").alias("file_path"))
        hits = rows.join(ids, key, "left_semi").groupBy("file_path").agg(F.count(F.lit(1)).alias("rows_deleted"))
        hits.write.mode("overwrite").parquet(f"{work}/log")
        touched = [r.file_path for r in spark.read.parquet(f"{work}/log").select("file_path").toLocalIterator()]
        if touched:
            old = spark.read.option("basePath", path).parquet(*touched)
            columns = old.columns
            kept = old.withColumn("_from", F.col("_metadata.file_path")).join(ids, key, "left_anti")
            out = kept.repartition("_from").select(*columns).write.mode("overwrite")
            (out.partitionBy(*partition_by) if partition_by else out).parquet(f"{work}/files")
    finish_erasure(spark, path, run)
    return spark.read.schema("file_path string, rows_deleted bigint").parquet(f"{work}/log")


def finish_erasure(spark: SparkSession, path: str, run: str) -> None:
    """Swap the rewritten files in; safe to repeat. One call to the store per touched file."""
    work = f"{path}/_erasure/{run}"
    staged, fs = _files(spark, f"{work}/files")
    if not fs.exists(staged):
        return
    for row in spark.read.parquet(f"{work}/log").select("file_path").toLocalIterator():
        old, _ = _files(spark, row.file_path)
        fs.delete(old, False)
    found = fs.listFiles(staged, True)
    home = str(fs.makeQualified(staged).toUri().getPath()).rstrip("/")
    while found.hasNext():
        new = found.next().getPath()
        relative = str(new.toUri().getPath()).removeprefix(home + "/")
        if relative.endswith(".parquet"):
            target, _ = _files(spark, f"{path}/{relative}")
            fs.mkdirs(target.getParent())
            fs.rename(new, target)
