"""A replica file laid out by its own bytes."""

from lakeloom.llm import fixity
from pyspark.sql import functions as F
from tests.llm.test_fixity import EDGES, PAGES, found, pages


def test_moved_records_are_no_damage(spark):
    placed = fixity.placed_records(pages(spark, PAGES + EDGES), archive_bytes=60_000).cache()
    lost, cut, altered = F.col("record_id").isin(40, 41), F.col("record_id") == 99, F.col("record_id") == 17
    kept = placed.where(~F.coalesce(lost, F.lit(False))).select(
        "archive",
        F.col("offset").alias("order"),
        "record_id",
        F.when(cut, F.col("length") - 3).otherwise(F.col("length")).alias("length"),
        F.when(altered | cut, F.lit("0" * 64)).otherwise(F.col("digest")).alias("digest"),
    )
    replica = fixity.with_offsets(kept, "order").drop("order").cache()
    where = {r.record_id: (r.archive, r.offset) for r in placed.collect()}
    own = {r.record_id: (r.archive, r.offset) for r in replica.collect()}
    assert sum(own[i] != where[i] for i in own) > 20
    want = sorted((*where[i], i, d) for i, d in ((17, "altered"), (40, "missing"), (41, "missing"), (99, "resized")))
    for sizes in ({}, {"range_bytes": 2048, "fanout": 2}):
        assert found(placed, replica, **sizes) == want
    back = sorted((*own.get(i, where[i]), i, d) for i, d in ((17, "altered"), (40, "added"), (41, "added"), (99, "resized")))
    assert found(replica, placed, range_bytes=2048, fanout=2) == back


def test_one_of_two_equal_records_is_lost(spark):
    placed = fixity.placed_records(pages(spark, EDGES)).cache()
    twice = [r for r in placed.collect() if r.record_id == 1003]
    first = min(twice, key=lambda r: r.offset)
    replica = fixity.with_offsets(placed.where(F.col("offset") != first.offset).withColumnRenamed("offset", "order"), "order")
    assert [(r[2], r[3]) for r in found(placed, replica)] == [(1003, "missing")]
