"""File layout: compaction, clustering, skipping statistics, archiving."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist for the length of a ``with`` block."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``file_path, file_size`` of every data file, from the listing; no file is opened."""
    return _listing(spark, path, "*.parquet").select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))


def _listing(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def source_profile(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files and bytes per directory, whatever the format; contents are not read."""
    listing = _listing(spark, path, pattern)
    return listing.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("directory")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 256 * 1024 * 1024) -> int:
    """Copy a folder of small files into files of about ``file_bytes``; returns their number.

    Only the total size, one number, reaches the driver.
    """
    total = file_sizes(spark, source).agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]
    files = max(1, math.ceil(total / file_bytes))
    spark.read.parquet(source).repartition(files).write.parquet(target)
    return files


def write_row_target(df: DataFrame, path: str, rows: int = 500_000, mode: str = "errorifexists") -> None:
    """Files of at most ``rows`` rows without counting the data first."""
    df.write.mode(mode).option("maxRecordsPerFile", rows).parquet(path)


def z_bounds(df: DataFrame, columns: Sequence[str], bits: int = 6) -> DataFrame:
    """One row ``b``: for each column the values that cut it into ``2 ** bits`` parts."""
    points = [i / 2**bits for i in range(1, 2**bits)]
    return df.agg(F.struct(*[F.percentile_approx(c, points, 10_000).alias(c) for c in columns]).alias("b"))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6, bounds: DataFrame | None = None) -> DataFrame:
    """Add ``_z``: the interleaved bits of each column's quantile number.

    Bounds come from one approximate-percentile aggregate, used as scalar subqueries, unless
    :func:`z_bounds` are given.
    """
    bounds = (z_bounds(df, columns, bits) if bounds is None else bounds).scalar()
    df = df.withColumn("_bounds", bounds)
    # how many bounds lie below each value, by binary search: one compare per bit, all of it
    # inside generated code
    df = df.withColumns({f"_q_{c}": F.lit(0) for c in columns})
    for bit in reversed(range(bits)):
        half = 2**bit
        df = df.withColumns(
            {
                f"_q_{c}": F.col(f"_q_{c}")
                + F.when(
                    F.get(F.col("_bounds")[c], F.col(f"_q_{c}") + (half - 1)) < F.col(c), half
                ).otherwise(0)
                for c in columns
            }
        )
    z: Column = F.lit(0).cast("bigint")
    width = len(columns)
    for bit in range(bits):
        for i, c in enumerate(columns):
            one = F.shiftright(F.col(f"_q_{c}"), bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * width + i))
    return df.withColumn("_z", z).drop("_bounds", *[f"_q_{c}" for c in columns])


def z_cluster(
    df: DataFrame, columns: Sequence[str], files: int, bits: int = 6, bounds: DataFrame | None = None
) -> DataFrame:
    """Rows laid out along a Z curve over ``columns``, ready to be written to ``files`` files.

    The columns themselves follow the curve in the range key, so rows of one crowded cell
    still spread over several files.
    """
    spread = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(1024))
    return (
        z_value(df, columns, bits, bounds)
        .repartitionByRange(files, F.col("_z"), *[F.col(c) for c in columns], spread)
        .sortWithinPartitions("_z", *columns)
        .drop("_z")
    )


def z_rewrite(
    spark: SparkSession, source: str, target: str, columns: Sequence[str], bounds: DataFrame, file_bytes: int = 256 * 1024 * 1024, bits: int = 6
) -> int:
    """Copy a folder along the Z curve into files of about ``file_bytes``; returns their number.

    The number follows the bytes that are listed; only their total reaches the driver.
    """
    total = file_sizes(spark, source).agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]
    files = max(1, math.ceil(total / file_bytes))
    z_cluster(spark.read.parquet(source), columns, files, bits, bounds).write.parquet(target)
    return files


def curve_overlaps(spark: SparkSession, path: str, columns: Sequence[str], bounds: DataFrame, bits: int = 6) -> DataFrame:
    """``files, overlaps``: files whose stretch of the curve begins before another one's end.

    Stretches are one row per file; a cell that several files share is no overlap.
    """
    rows = spark.read.parquet(path).select(*columns, F.col("_metadata.file_path").alias("file_path"))
    per_file = z_value(rows, columns, bits, bounds).groupBy("file_path").agg(F.min("_z").alias("lo"), F.max("_z").alias("hi"))
    per_file = per_file.withColumn("all", F.lit(0))
    before = Window.partitionBy("all").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    return per_file.withColumn("reached", F.max("hi").over(before)).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("lo") < F.col("reached")).alias("overlaps")
    )


def column_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column per file."""
    made = []
    for c in columns:
        made += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count(F.lit(1)).alias("rows"), *made)
    )


def footer_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """:func:`column_ranges` from the files' footers alone; no data page is read.

    Tasks open the listed files and read their last bytes, through the file systems that Arrow
    knows; in a store that only Spark reads, use :func:`column_ranges`. A range is NULL where
    the writer left out statistics (say for NaN) although there are values.
    """
    schema = spark.read.parquet(path).select(*columns).schema
    out = T.StructType().add("file_path", "string").add("rows", "long")
    for f in schema:
        out = out.add(f"min_{f.name}", f.dataType).add(f"max_{f.name}", f.dataType)
    listed = file_sizes(spark, path).select("file_path")
    return listed.mapInArrow(_read_footers(to_arrow_schema(out), list(columns)), out)


def _read_footers(schema, columns: list[str]):
    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def ends(footer, column: str):
            """Smallest and largest value over all row groups, None if one of them is not known."""
            at = footer.schema.to_arrow_schema().get_field_index(column)
            low = high = None
            for g in range(footer.num_row_groups):
                part = footer.row_group(g)
                found = [part.column(i) for i in range(part.num_columns) if part.column(i).path_in_schema == column]
                stats = found[0].statistics if at >= 0 and found else None
                if stats is not None and stats.null_count == part.num_rows:
                    continue
                if stats is None or not stats.has_min_max:
                    return None, None
                low = stats.min if low is None else min(low, stats.min)
                high = stats.max if high is None else max(high, stats.max)
            return low, high

        for batch in batches:
            lines = [[] for _ in schema]
            for name in batch.column(0).to_pylist():
                store, inner = fs.FileSystem.from_uri(name)
                with store.open_input_file(inner) as file:
                    footer = pq.read_metadata(file)
                values = [name, footer.num_rows]
                for c in columns:
                    values += ends(footer, c)
                for line, value in zip(lines, values):
                    line.append(value)
            arrays = [pa.array(line, f.type) for line, f in zip(lines, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return read


def files_met(ranges: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    """How many files a range predicate has to open; those of unknown range count."""
    meets = (F.col(f"min_{column}") <= high) & (F.col(f"max_{column}") >= low)
    return ranges.agg(
        F.count(F.lit(1)).alias("files"),
        F.count(F.when(F.coalesce(meets, F.lit(True)), F.lit(1))).alias("files_met"),
    )


def partition_advice(
    df: DataFrame, columns: Sequence[str], max_values: int = 1000, min_rows: int = 1_000_000
) -> DataFrame:
    """Per column: approximate cardinality, rows per value, and partition/cluster/none."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.approx_count_distinct(c, 0.02).alias(c) for c in columns],
    )
    per_value = F.col("rows") / F.greatest("approx_values", F.lit(1))
    advice = (
        F.when(F.col("approx_values") <= 1, "none")
        .when((F.col("approx_values") <= max_values) & (per_value >= min_rows), "partition")
        .otherwise("cluster")
    )
    return counted.unpivot("rows", list(columns), "column_name", "approx_values").select(
        "column_name",
        "approx_values",
        F.round(per_value, 2).alias("rows_per_value"),
        advice.alias("advice"),
    )


def archive_split(df: DataFrame, is_old: Column) -> tuple[DataFrame, DataFrame]:
    """``(archive, hot)``; rows whose age is unknown stay hot."""
    old = F.coalesce(is_old, F.lit(False))
    return df.where(old), df.where(~old)
