"""File readers with an explicit schema, and guarded reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# The option set of a production CSV read.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "false",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "nullValue": "NULL",
    "emptyValue": "",
    "nanValue": "NaN",
    "positiveInf": "Inf",
    "negativeInf": "-Inf",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "encoding": "UTF-8",
    "maxCharsPerColumn": "-1",
    "mode": "PERMISSIVE",
}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, **options: str
) -> DataFrame:
    """CSV with every option of :data:`CSV_OPTIONS`, each of which may be overridden.

    Nothing is cut or skipped by default: fields of any length are read, and lines that begin
    with a comment sign are data unless ``comment`` is passed. ``multiLine="true"`` allows line
    breaks inside quotes, but keeps a file in one task.
    """
    return spark.read.options(**{**CSV_OPTIONS, **options}).schema(schema).csv(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of a permissive read that has the corrupt-record column.

    Spark refuses to read that column alone from raw text, so stage or cache ``df`` first
    when the bad rows are only counted; the text is then parsed once as well.
    """
    bad = df.where(F.col(CORRUPT).isNotNull())
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, bad


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path)


def read_parquet(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Parquet, with the expected schema enforced when it is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    paths = [path] if isinstance(path, str) else path
    return reader.parquet(*paths)


def read_orc(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).orc(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("rowTag", row_tag).schema(schema).xml(path)


def read_avro(spark: SparkSession, path: str, reader_schema: str | None = None) -> DataFrame:
    """Avro with an optional reader schema; needs the spark-avro package on the cluster."""
    reader = spark.read.format("avro")
    if reader_schema:
        reader = reader.option("avroSchema", reader_schema)
    return reader.load(path)


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | str, format: str = "parquet"
) -> DataFrame | None:
    """``None`` when the path is missing or holds no rows; every other error surfaces."""
    try:
        df = spark.read.format(format).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if df.isEmpty() else df


def with_ingest_columns(df: DataFrame, batch: str, run_id: str, ingested_at=None) -> DataFrame:
    """Lineage columns of the bronze layer. ``df`` must come straight from files."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return df.select(
        "*",
        stamp.alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(batch).alias("_batch_date"),
        F.lit(run_id).alias("_run_id"),
    )


def explode_pages(pages: DataFrame, arrays: Sequence[str] = ("data", "results")) -> DataFrame:
    """Records of saved API responses: the first of ``arrays`` that a page has."""
    record = F.explode(F.coalesce(*[F.col(a) for a in arrays])).alias("record")
    return pages.select(record).select("record.*")
