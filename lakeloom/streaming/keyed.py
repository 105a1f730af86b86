"""A table that a stream upserts into: hashed buckets, a folded base and the batches since.

``changes/batch_id=b/bucket=k`` has the newest rows per key of a batch; ``base/upto=b/bucket=k``
what a fold made of a bucket; ``folds/batch_id=b`` names the buckets of a finished fold and is
written last, so a fold that broke off is not seen. A bucket's base is that of its newest
fold, its changes are the batches after it. A fold takes up only buckets that changed, so its
cost follows the changes and not the table, and the number of files stays bounded by buckets and
batches between folds.

Batches replayed after their fold lose against it. What a fold replaces is deleted by the
next fold, so readers that began before a fold still find their files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.ordered import latest_per_key

BATCH = "_batch"


@dataclass(frozen=True)
class KeyedTable:
    """Settings of one table; ``order`` ranks rows of a key, later batches win ties.

    ``columns`` is the schema of the rows as DDL. ``buckets`` is fixed for the table's life.
    """

    spark: SparkSession
    path: str
    columns: str
    keys: tuple[str, ...]
    order: tuple[Column, ...] = ()
    buckets: int = 64
    fold_every: int = 16

    def _folder(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _has(self, name: str) -> bool:
        path, fs = self._folder(name)
        return fs.exists(path)

    def _read(self, name: str, more: str) -> DataFrame:
        if not self._has(name):
            return self.spark.createDataFrame([], f"{self.columns}, {more}")
        return self.spark.read.schema(f"{self.columns}, {more}").parquet(f"{self.path}/{name}")

    def _folds(self) -> list[tuple[int, int]]:
        """``bucket, upto`` of the newest fold of every bucket: at most one pair per bucket."""
        if not self._has("folds"):
            return []
        rows = self.spark.read.schema("bucket int, batch_id bigint").parquet(f"{self.path}/folds")
        newest = rows.groupBy("bucket").agg(F.max("batch_id").alias("upto"))
        return [(r[0], r[1]) for r in newest.agg(F.collect_list(F.struct("bucket", "upto"))).first()[0]]

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, list(self.keys), [*self.order, F.col(BATCH).desc()])

    def _split(self, upto: int | None = None) -> tuple[DataFrame, DataFrame, list[int]]:
        """Rows of the base, rows of later batches up to ``upto``, and the buckets these touch."""
        folds = self._folds()
        base = self._read("base", f"{BATCH} bigint, upto bigint, bucket int")
        changes = self._read("changes", "batch_id bigint, bucket int")
        current, later = F.lit(False), ~F.col("bucket").isin(*[k for k, _ in folds])
        for fold in sorted({u for _, u in folds}):
            of = F.col("bucket").isin(*[k for k, u in folds if u == fold])
            current = current | ((F.col("upto") == fold) & of)
            later = later | (of & (F.col("batch_id") > fold))
        base, changes = base.where(current).drop("upto"), changes.where(later)
        if upto is not None:
            changes = changes.where(F.col("batch_id") <= upto)
        touched = changes.agg(F.collect_set("bucket")).first()[0]
        changes = changes.withColumnRenamed("batch_id", BATCH)
        return base, changes, sorted(touched)

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        """Handler of a micro-batch; folds the committed batches now and then."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        names = [f.name for f in self.spark.createDataFrame([], self.columns).schema]
        newest = latest_per_key(df.select(*names), list(self.keys), list(self.order) or [F.lit(0)])
        rows = newest.withColumn("bucket", bucket).repartition("bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/changes/batch_id={batch_id}")
        if batch_id and batch_id % self.fold_every == 0:
            self.fold(batch_id - 1)  # this batch is not committed yet

    def fold(self, upto: int) -> None:
        """Take the batches up to ``upto`` into the base of the buckets they touch."""
        self._clean()
        base, changes, touched = self._split(upto)
        if not touched:
            return
        rows = base.where(F.col("bucket").isin(*touched)).unionByName(changes)
        folded = self._newest(rows).repartition("bucket")
        folded.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/upto={upto}")
        names = self.spark.createDataFrame([(k,) for k in touched], "bucket int")
        names.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folds/batch_id={upto}")

    def _clean(self) -> None:
        """Delete what the last finished folds have replaced."""
        folds = self._folds()
        if not folds:
            return
        newest, last = dict(folds), max(u for _, u in folds)
        changes, fs = self._folder("changes")
        for batch in fs.listStatus(changes):
            # The last fold took up all that was open, in whatever bucket.
            if int(batch.getPath().getName().split("=")[1]) <= last:
                fs.delete(batch.getPath(), True)
        for fold in fs.listStatus(self._folder("base")[0]):
            upto, kept = int(fold.getPath().getName().split("=")[1]), 0
            for bucket in fs.listStatus(fold.getPath()):
                name = bucket.getPath().getName()
                if name.startswith("bucket="):
                    if newest.get(int(name.split("=")[1])) == upto:
                        kept += 1
                    elif upto <= last:
                        fs.delete(bucket.getPath(), True)
            if not kept and upto <= last:
                fs.delete(fold.getPath(), True)

    def rows(self) -> DataFrame:
        """The table: buckets without later changes are read as they lie, without a shuffle."""
        base, changes, touched = self._split()
        rest = base.where(~F.col("bucket").isin(*touched)) if touched else base
        out = rest if not touched else rest.unionByName(
            self._newest(base.where(F.col("bucket").isin(*touched)).unionByName(changes))
        )
        return out.drop("bucket", BATCH)

    def n_files(self) -> int:
        """Data files of base and changes."""
        def count(name: str) -> int:
            return len(self.spark.read.schema(self.columns).parquet(f"{self.path}/{name}").inputFiles()) if self._has(name) else 0

        return count("base") + count("changes")


def keyed_table(spark: SparkSession, path: str, columns: str, keys: Sequence[str], order: Sequence[Column] = (), **settings: int) -> KeyedTable:
    return KeyedTable(spark, path, columns, tuple(keys), tuple(order), **settings)
