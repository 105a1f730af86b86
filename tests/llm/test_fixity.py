from lakeloom.llm import fixity
from pyspark.sql import functions as F
from tests.llm.conftest import CLASHES

PAGES = [(k, f"http://host/{k}", "<p>" + "text " * (k * 37 % 400) + "</p>") for k in range(300)]
EDGES = [(None, None, None), (1000, None, ""), (1001, "u", None), (1002, "u", "x" * 300_000), (1003, "u", "same"), (1003, "u", "same")]


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df


def found(a, b, **sizes):
    return sorted((r.archive, r.offset, r.record_id, r.damage) for r in fixity.audit(a, b, **sizes).collect())


def test_damage_is_located(spark):
    placed = fixity.placed_records(pages(spark, PAGES + EDGES), archive_bytes=60_000).cache()
    rows = placed.collect()
    assert len(rows) == len(PAGES + EDGES)
    # Records of an archive follow each other without gaps.
    for archive in {r.archive for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.archive == archive), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
    assert found(placed, placed) == []
    altered, lost, cut = F.col("record_id") == 17, F.col("record_id").isin(40, 41), F.col("record_id") == 99
    replica = (
        placed.where(~F.coalesce(lost, F.lit(False)))
        .withColumn("digest", F.when(altered | cut, F.lit("0" * 64)).otherwise(F.col("digest")))
        .withColumn("length", F.when(cut, F.col("length") - 3).otherwise(F.col("length")))
    )
    place = {r.record_id: (r.archive, r.offset) for r in rows}
    want = sorted((*place[i], i, d) for i, d in ((17, "altered"), (40, "missing"), (41, "missing"), (99, "resized")))
    for sizes in ({}, {"range_bytes": 2048, "fanout": 2}, {"range_bytes": 1 << 30}):
        assert found(placed, replica, **sizes) == want
    assert found(replica.where("record_id = 17"), placed.where("record_id = 17 OR record_id = 40")) == sorted(
        [(*place[17], 17, "altered"), (*place[40], 40, "added")]
    )


def test_empty_table(spark):
    empty = fixity.placed_records(pages(spark, PAGES).limit(0))
    assert empty.count() == 0
    assert fixity.audit(empty, empty).count() == 0


def test_record_bytes(spark):
    row = pages(spark, [(7, "http://é", "<b>ß</b>")]).select(fixity.record(F.col("page_id"), F.col("url"), F.col("html"))).first()
    head, body = bytes(row[0]).split(b"\r\n\r\n", 1)
    assert head.splitlines()[0] == b"WARC/1.0" and b"Content-Length: 9" in head
    assert body == "<b>ß</b>".encode() + b"\r\n\r\n"
