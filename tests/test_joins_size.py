from conftest import rows
from pyspark.sql import functions as F

from lakeloom.operators import joins


def test_nested_columns_count_by_their_content(spark):
    df = spark.range(1).selectExpr("sequence(1, 100000) AS a", "map('k', repeat('x', 1000)) AS m", "named_struct('f', repeat('x', 1000)) AS s")
    assert joins.measured_size(df)[1] > 400_000
    assert joins.measured_size(df.select("m"))[1] > 1000 and joins.measured_size(df.select("s"))[1] > 1000
    assert joins.measured_size(spark.sql("SELECT CAST(NULL AS array<int>) AS a")) == (1, 0)
    assert joins.broadcast_if_small(df, max_bytes=100_000) is df


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_with_many_rows_is_not_broadcast(spark):
    """Spark estimates what an explode makes by its input: here some KB for 250,000 versions."""
    parts = spark.range(5_000).selectExpr("id AS k", "explode(sequence(0, 49)) AS v")
    history = parts.selectExpr("k", "v", "date_add(DATE'2024-01-01', v) AS valid_from", "date_add(DATE'2024-01-01', v + 1) AS valid_to")
    facts = spark.range(0, 5_200, 40).selectExpr("id AS k", "date_add(DATE'2024-01-01', CAST(id % 60 AS INT)) AS at")
    want = sorted(((k, k % 60 if k % 60 < 50 and k < 5_000 else None) for k in range(0, 5_200, 40)), key=str)
    for how in ({}, {"slice_days": 7, "horizon": F.lit("2024-02-10").cast("date")}):
        joined = joins.as_of_join(facts, history, "k", "at", ["v"], **how)
        assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)
        assert rows(joined, "k", "v") == want
    few = joins.as_of_join(facts, history.where("k < 10"), "k", "at", ["v"])
    assert "BroadcastHashJoin" in plan(few)
