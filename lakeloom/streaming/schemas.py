"""Schema evolution of streams: stored versions, and handlers that follow a mode.

A stream that is restarted, or replays a batch, must see the schema it saw before. Versions
therefore lie beside the checkpoint, each in a folder named after the batch that brought it:
batch ``b`` continues the newest version of an earlier batch, so a replay finds the schema it
started from and writes its own version again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sources.landing import RESCUED, conform, evolve_schema, parse_rescuing
from lakeloom.streaming.batches import Handler, write_batch

#: New fields of one batch beyond which its lines are taken for damaged.
MOST_NEW_COLUMNS = 1_000


class SchemaStore:
    """Schema versions below ``path``."""

    COLUMNS = "version bigint, schema string, batch_id bigint"
    #: The batch of the version a table begins with, and of one accepted by hand before any batch.
    START = -1

    def __init__(self, spark: SparkSession, path: str, start: T.StructType | None = None):
        self.spark, self.path = spark, path
        if start is not None and not self._exists():
            self._write(self.START, 0, start)

    def _exists(self) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def _write(self, batch_id: int, version: int, schema: T.StructType) -> None:
        row = self.spark.createDataFrame([(version, schema.json())], "version bigint, schema string")
        write_batch(row.coalesce(1), self.path, batch_id)

    def versions(self) -> DataFrame:
        """``version, schema, batch_id`` of every version."""
        return self.spark.read.schema(self.COLUMNS).parquet(self.path)

    def before(self, batch_id: int) -> tuple[int, T.StructType]:
        """The version that a batch starts from."""
        found = self.versions().where(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()
        if found is None:
            raise ValueError(f"no schema before batch {batch_id} in {self.path}")
        return found.version, T.StructType.fromJson(json.loads(found.schema))

    def latest(self) -> T.StructType:
        return self.before(2**62)[1]

    def save(self, batch_id: int, schema: T.StructType) -> None:
        """The schema after a batch; a version only if the batch changed it."""
        version, known = self.before(batch_id)
        if schema != known:
            self._write(batch_id, version + 1, schema)

    def accept(self, added: T.StructType, batch_id: int) -> None:
        """Add columns by hand before ``batch_id`` is tried again, as ``failOnNewColumns`` asks for."""
        version, known = self.before(batch_id)
        names = set(known.names)
        self._write(batch_id - 1, version + 1, T.StructType([*known, *(f for f in added if f.name not in names)]))


def unknown_fields(lines: DataFrame, text: str, known: T.StructType) -> T.StructType:
    """Fields of JSON lines that ``known`` lacks, in order of name, each with the narrowest
    of long, double, boolean and string that reads all its values."""
    fields = lines.select(F.explode(F.from_json(F.col(text), "map<string,string>")).alias("name", "value"))
    reads = {"bigint": F.col("value").try_cast("bigint"), "double": F.col("value").try_cast("double")}
    reads["boolean"] = F.when(F.col("value").isin("true", "false"), True)
    fits = [F.bool_and(F.col("value").isNull() | c.isNotNull()).alias(kind) for kind, c in reads.items()]
    seen = fields.where(~F.col("name").isin(*known.names)).groupBy("name").agg(F.count("value").alias("n"), *fits)
    kind = F.when(F.col("n") == 0, "string")
    for name in reads:
        kind = kind.when(F.col(name), name)
    named = seen.select("name", kind.otherwise("string").alias("kind")).limit(MOST_NEW_COLUMNS + 1)
    found = named.agg(F.sort_array(F.collect_list(F.struct("name", "kind")))).first()[0]
    if len(found) > MOST_NEW_COLUMNS:
        raise ValueError(f"more than {MOST_NEW_COLUMNS} new columns in one batch")
    out = T.StructType()
    for f in found:
        out = out.add(f["name"], T.DataType.fromDDL(f["kind"]))
    return out


def evolving_handler(path: str, store: SchemaStore, mode: str) -> Handler:
    """Store typed batches under a schema-evolution mode."""

    def handle(df: DataFrame, batch_id: int) -> None:
        fitted, schema = conform(df, store.before(batch_id)[1], mode)
        write_batch(fitted, path, batch_id)
        store.save(batch_id, schema)

    return handle


def evolving_json_handler(path: str, store: SchemaStore, mode: str, text: str = "value") -> Handler:
    """Store batches of JSON lines under a schema-evolution mode.

    ``addNewColumns`` takes new fields up with the type their values have and goes on;
    ``rescue`` keeps the schema and puts them, like values that do not fit their type, into
    ``_rescued_data``; ``none`` leaves them out; ``failOnNewColumns`` raises before anything of
    the batch is written, and the stream goes on from there once the columns are accepted.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        _, known = store.before(batch_id)
        schema = known
        if mode in ("addNewColumns", "failOnNewColumns"):
            added = unknown_fields(df, text, known)
            schema = evolve_schema(known, T.StructType([*known, *added]), mode)
        elif mode not in ("rescue", "none"):
            raise ValueError(f"unknown mode {mode!r}")
        parsed = parse_rescuing(df.select(text), text, schema)
        write_batch(parsed if mode == "rescue" else parsed.drop(RESCUED), path, batch_id)
        store.save(batch_id, schema)

    return handle


def stored_rows(spark: SparkSession, path: str, store: SchemaStore, mode: str) -> DataFrame:
    """What the handlers stored, in the newest schema; columns older batches lack are NULL."""
    schema = T.StructType([*store.latest()])
    if mode == "rescue":
        schema = schema.add(RESCUED, T.StringType())
    return spark.read.schema(schema).parquet(path).drop("batch_id")
