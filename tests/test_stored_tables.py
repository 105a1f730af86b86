"""Operators on stored tables: footers, curve order, erasure in place, digests, stored counts."""

import math
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeloom.operators import access, changes, layout, quality
from lakeloom.session import workspace


def sample(spark, n=2000):
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 7 != 0, F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int")).alias("i"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) / 8).alias("x"),
        F.concat(F.lit("é"), F.col("id").cast("string")).alias("s"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("d"),
        (F.col("id") * 1.25).cast("decimal(12,2)").alias("m"),
        F.timestamp_seconds(F.col("id") * 1000).alias("t"),
        F.lit(None).cast("string").alias("none"),
    )


def test_footers_say_what_a_scan_says(spark):
    path = workspace(spark, "footers")
    sample(spark).repartition(5).write.option("parquet.block.size", 4096).parquet(path)
    columns = ["i", "x", "s", "d", "m", "none"]
    name = F.regexp_extract("file_path", "[^/]+$", 0).alias("file_path")
    found, scanned = layout.footer_ranges(spark, path, columns), layout.column_ranges(spark, path, columns)
    assert found.dtypes == scanned.dtypes
    assert rows(found.withColumn("file_path", name)) == rows(scanned.withColumn("file_path", name))


def test_unknown_ranges_count_as_met(spark):
    path = workspace(spark, "nan")
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").coalesce(1).write.parquet(path)
    met = layout.files_met(layout.footer_ranges(spark, path, ["x"]), "x", F.lit(500.0), F.lit(600.0))
    assert rows(met) == [(1, 1)]


def test_an_unsorted_write_overlaps_on_the_curve(spark):
    source, sorted_path = workspace(spark, "plain"), workspace(spark, "curve")
    sample(spark).repartition(6).write.parquet(source)
    by = ["x", "d"]
    bounds = layout.z_bounds(spark.read.parquet(source), by)
    size = layout.file_sizes(spark, source).agg(F.sum("file_size")).first()[0]
    for file_bytes, files in ((size, 1), (math.ceil(size / 5), 5)):
        target = f"{sorted_path}-{files}"
        assert layout.z_rewrite(spark, source, target, by, bounds, file_bytes) == files
        assert rows(layout.curve_overlaps(spark, target, by, bounds)) == [(files, 0)]
        assert rows(spark.read.parquet(target)) == rows(spark.read.parquet(source))
    assert layout.curve_overlaps(spark, source, by, bounds).first().overlaps > 0


def listing(path):
    return {
        os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
        for folder, _, names in os.walk(path.removeprefix("file:"))
        for f in names
        if f.endswith(".parquet") and "_erasure" not in folder
    }


@pytest.mark.parametrize("by", [[], ["part"]])
def test_erasure_rewrites_touched_files_only(spark, by, monkeypatch):
    path = workspace(spark, "erase")
    df = spark.range(400).select("id", (F.col("id") % 40).alias("customer"), (F.col("id") % 3).alias("part"))
    laid = df.repartitionByRange(6, "customer").write
    (laid.partitionBy(*by) if by else laid).parquet(path)
    before = listing(path)
    requests = spark.createDataFrame([(3,), (4,), (None,), (4,), (99,)], "customer long")

    with monkeypatch.context() as broken:
        # the run breaks off before the files are swapped, and is repeated
        broken.setattr(access, "finish_erasure", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            access.erase_files(spark, path, "customer", requests, "r1", by)
        assert listing(path) == before
    log = access.erase_files(spark, path, "customer", requests, "r1", by)
    access.finish_erasure(spark, path, "r1")

    assert log.agg(F.sum("rows_deleted")).first()[0] == 20
    left = spark.read.parquet(path)
    assert rows(left, "id", "customer", "part") == rows(df.where("customer NOT IN (3, 4)"), "id", "customer", "part")
    touched = {r.file_path.rsplit("/", 1)[1] for r in log.collect()}
    after = listing(path)
    for name, time in before.items():
        if name.rsplit("/", 1)[1] in touched:
            assert name not in after
        else:
            assert after[name] == time
    assert len(touched) < len(before)


def test_erasure_without_hits(spark):
    path = workspace(spark, "erase-none")
    spark.range(10).withColumn("customer", F.col("id")).write.parquet(path)
    before = listing(path)
    log = access.erase_files(spark, path, "customer", spark.createDataFrame([(77,)], "customer long"), "r")
    assert log.count() == 0 and listing(path) == before


def test_digests_find_the_buckets_that_differ(spark):
    old = spark.range(500).select("id", F.when(F.col("id") % 5 != 0, F.col("id")).alias("v"))
    same = old.select("v", "id").repartition(3)
    assert changes.differing_buckets(old, same, ["id"], 64).count() == 0
    new = old.where("id <> 7").withColumn("v", F.when(F.col("id") == 10, 1).when(F.col("id") == 11, None).otherwise(F.col("v"))).union(
        spark.createDataFrame([(900, 1)], "id long, v long")
    )
    assert 0 < changes.differing_buckets(old, new, ["id"], 64).count() <= 4
    at = F.lit("2024-01-01").cast("timestamp")
    for buckets in (1, 64):
        got = changes.compare_versions(old, new, ["id"], 1, at, buckets)
        assert rows(got) == rows(changes.change_feed(old, new, ["id"], 1, at))
    assert changes.compare_versions(old, same, ["id"], 1, at).count() == 0


def test_equal_versions_shuffle_digests_only(spark):
    path = workspace(spark, "version")
    spark.range(50_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(path)
    one, two = spark.read.parquet(path), spark.read.parquet(path)
    plan = changes.differing_buckets(one, two, ["id"], 16)._jdf.queryExecution().toString()
    for line in plan.split("== Physical Plan ==")[1].splitlines():
        if "Exchange hashpartitioning" in line:
            assert "bucket" in line and "text" not in line


def test_expectation_rows_are_replayed_and_fail_leaves_none(spark):
    out = workspace(spark, "expected")
    df = spark.createDataFrame([(1, 5), (2, None), (None, 7)], "id long, v long")
    handle = quality.expectation_handler(f"{out}/data", f"{out}/log", {"id": "id IS NOT NULL", "v": "v > 4"}, "drop")
    for batch in (0, 1, 1):
        handle(df, batch)
    want = [(b, n, "drop", 3, 1, False) for b in (0, 1) for n in ("id", "v")]
    found = quality.expectation_results(spark, f"{out}/log")
    assert rows(found, "batch_id", "expectation", "action", "rows", "failed", "passed") == want
    assert spark.read.parquet(f"{out}/data").count() == 2
    with pytest.raises(Exception, match="expectation failed"):
        quality.write_expected(df, f"{out}/data", f"{out}/log", {"v": "v > 4"}, "fail", 2)
    assert found.where("batch_id = 2").count() == 0


def test_stored_percentiles_by_brute_force(spark):
    rng = random.Random(4)
    values = [(rng.choice("abc"), rng.choice([None, rng.randint(-50, 3000) / 4])) for _ in range(700)]
    path = workspace(spark, "histograms")
    df = spark.createDataFrame(values, "period string, v double")
    quality.store_histograms(df, path, "period", "v", 0.5)
    quality.store_histograms(df.where("period = 'b'"), path, "period", "v", 0.5)
    points = {"lowest": 0.0001, "p50": 0.5, "p95": 0.95, "all": 1.0}
    bins = sorted(math.floor(v / 0.5) * 0.5 for _, v in values if v is not None)
    want = {n: bins[math.ceil(p * len(bins)) - 1] for n, p in points.items()}
    for block in (3, 1024):
        got = quality.stored_percentiles(spark.read.parquet(path), points, block)
        assert dict(rows(got, "percentile", "value")) == want
