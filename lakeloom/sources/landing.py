"""Schema-on-read for landed text: rescued data and schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def parse_rescuing(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """JSON text to typed columns; whatever does not fit goes to ``_rescued_data``.

    Rescued are fields the schema does not know, and fields present with a value that
    cannot be read as the declared type. A line that is no JSON object is rescued whole.
    """
    source = F.col(text)
    typed = F.from_json(source, schema)
    loose = F.from_json(source, "map<string,string>")
    kept = [c for c in df.columns if c != text]
    parsed = df.select(*kept, source.alias("_line"), typed.alias("_typed"), loose.alias("_loose"))
    misfit = F.map_filter("_loose", lambda name, _: ~name.isin(*schema.names))
    uncast = [
        F.when(
            F.col("_loose")[f.name].isNotNull() & F.col("_typed")[f.name].isNull(),
            F.create_map(F.lit(f.name), F.col("_loose")[f.name]),
        )
        for f in schema
    ]
    none = F.create_map().cast("map<string,string>")
    bad = F.map_concat(misfit, *[F.coalesce(m, none) for m in uncast])
    rescued = F.when(F.col("_loose").isNull(), F.col("_line")).otherwise(
        F.when(F.size(bad) > 0, F.to_json(bad))
    )
    return parsed.select(*kept, "_typed.*", rescued.alias(RESCUED))


def new_columns(known: T.StructType, seen: T.StructType) -> list[T.StructField]:
    return [f for f in seen if f.name not in known.names]


def evolve_schema(known: T.StructType, seen: T.StructType, mode: str) -> T.StructType:
    """The schema to continue with under a schema-evolution mode.

    ``addNewColumns`` widens it, ``failOnNewColumns`` raises, ``rescue`` and ``none`` keep it.
    """
    added = new_columns(known, seen)
    if mode == "addNewColumns":
        return T.StructType([*known.fields, *added])
    if mode == "failOnNewColumns":
        if added:
            raise ValueError(f"new columns: {[f.name for f in added]}")
        return known
    if mode in ("rescue", "none"):
        return known
    raise ValueError(f"unknown mode {mode!r}")


def conform(df: DataFrame, known: T.StructType, mode: str) -> tuple[DataFrame, T.StructType]:
    """Fit a micro-batch to the table under ``mode``; also the schema to store.

    ``rescue`` keeps the values of unknown columns as JSON in ``_rescued_data``.
    """
    target = evolve_schema(known, df.schema, mode)
    columns = [
        F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        for f in target
    ]
    out = [c.alias(f.name) for c, f in zip(columns, target)]
    if mode == "rescue":
        extra = [f.name for f in new_columns(known, df.schema)]
        any_extra = F.coalesce(*[F.col(c).cast("string") for c in extra]) if extra else F.lit(None)
        packed = F.to_json(F.struct(*extra)) if extra else F.lit(None).cast("string")
        out.append(F.when(any_extra.isNotNull(), packed).alias(RESCUED))
    return df.select(*out), target


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream of the files that arrive in a folder, at most ``max_files`` per batch."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
