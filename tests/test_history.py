import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from lakeloom.operators import changes, history

D = lambda n: dt.datetime(2024, 1, n)


def start(spark):
    df = spark.createDataFrame([("A", "Mumbai", "x"), ("B", None, "y"), ("C", "Pune", "z")], "k string, city string, note string")
    return history.open_history(df, F.lit(D(1)))


def batch(spark, *lines):
    return spark.createDataFrame(list(lines), "k string, city string, note string, at timestamp")


def test_change_closes_and_opens_null_safely(spark):
    out = history.scd2(start(spark), batch(spark, ("A", "Delhi", "x", D(5)), ("B", "Goa", "y", D(5)), ("C", None, "z", D(5)), ("N", "Agra", "n", D(5))), "k", ["city"], "at")
    got = rows(out, "k", "city", "valid_from", "valid_to", "is_current")
    assert ("A", "Mumbai", D(1), D(5), False) in got and ("A", "Delhi", D(5), None, True) in got
    assert ("B", None, D(1), D(5), False) in got and ("C", None, D(5), None, True) in got
    assert ("N", "Agra", D(5), None, True) in got
    assert len(got) == 7


def test_unchanged_and_rerun_are_no_ops(spark):
    b = batch(spark, ("A", "Delhi", "x", D(5)), ("C", "Pune", "changed but untracked", D(5)))
    once = history.scd2(start(spark), b, "k", ["city"], "at")
    assert rows(history.scd2(once, b, "k", ["city"], "at")) == rows(once)
    assert once.where("k = 'C'").count() == 1


def test_several_and_late_versions(spark):
    b = batch(spark, ("A", "Delhi", "", D(5)), ("A", "Goa", "", D(9)), ("A", "Goa", "", D(11)))
    once = history.scd2(start(spark), b, "k", ["city"], "at")
    late = history.scd2(once, batch(spark, ("A", "Agra", "", D(7))), "k", ["city"], "at")
    line = rows(late.where("k = 'A'"), "valid_from", "city", "valid_to")
    assert line == [(D(1), "Mumbai", D(5)), (D(5), "Delhi", D(7)), (D(7), "Agra", D(9)), (D(9), "Goa", None)]


def test_one_current_row_and_no_overlap(spark):
    b = batch(spark, ("A", "Delhi", "", D(5)), ("A", "Mumbai", "", D(6)), ("B", "Goa", "", D(6)))
    out = history.scd2(start(spark), b, "k", ["city"], "at")
    assert {r["count"] for r in out.where("is_current").groupBy("k").count().collect()} == {1}
    later = out.select("k", F.col("valid_from").alias("f2"), F.col("valid_to").alias("t2"))
    clash = out.join(later, "k").where((F.col("valid_from") < F.col("f2")) & (F.coalesce("valid_to", F.lit(D(30))) > F.col("f2")))
    assert clash.isEmpty()
    assert rows(history.state_as_of(out, F.lit(D(5))).where("k = 'A'"), "city") == [("Delhi",)]


def test_replay_inverts_change_feed(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id bigint, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "n")], "id bigint, v string")
    log = changes.initial_feed(a, 0, F.lit(D(1))).unionByName(changes.change_feed(a, b, ["id"], 1, F.lit(D(2))))
    assert rows(changes.replay(log, ["id"])) == rows(b)
    assert rows(changes.replay(log, ["id"], version=0)) == rows(a)
    kinds = rows(changes.change_summary(log.where("_commit_version = 1")), "_change_type", "rows")
    assert kinds == [("delete", 1), ("insert", 1), ("update_postimage", 1), ("update_preimage", 1)]


def test_refresh_drops_emptied_groups(spark):
    a = spark.createDataFrame([(1, "g", 5.0), (2, "h", 6.0)], "id bigint, g string, v double")
    b = a.where("id = 1")
    feed = changes.change_feed(a, b, ["id"], 1, F.lit(D(1)))
    total = [F.sum("v").alias("s")]
    gold = a.groupBy("g").agg(*total)
    assert rows(changes.refresh_aggregate(gold, b, feed, ["g"], total)) == [("g", 5.0)]


def test_a_closed_key_that_returns_opens_a_version(spark):
    closed = start(spark).withColumn("valid_to", F.lit(D(5)).cast("timestamp")).withColumn("is_current", F.lit(False))
    again = batch(spark, ("A", "Mumbai", "x", D(10)), ("B", None, "y", D(3)))
    out = history.scd2(closed, again, "k", ["city"], "at")
    got = rows(out, "k", "valid_from", "valid_to", "is_current")
    assert [r for r in got if r[0] == "A"] == [("A", D(1), D(5), False), ("A", D(10), None, True)]
    assert [r for r in got if r[0] == "B"] == [("B", D(1), D(5), False)]
    assert rows(history.scd2(out, again, "k", ["city"], "at")) == rows(out)
