"""Plans: what must be pushed down, pruned, limited early or not shuffled."""

import pytest
from pyspark.sql import functions as F

from lakeloom.catalogue import ENTRIES, Tables
from lakeloom.operators import ordered
from lakeloom.session import workspace

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_filter_and_columns_reach_the_scan(t):
    text = plan(ENTRIES["p10_in_between"].build(t))
    assert "GreaterThanOrEqual(o_totalprice,100000" in text and "In(o_orderpriority" in text
    assert "o_custkey" not in text.split("ReadSchema")[1].split("\n")[0]


def test_partition_filter(t):
    text = plan(ENTRIES["s05_parquet_pruned_read"].build(t))
    line = next(x for x in text.splitlines() if "PartitionFilters" in x)
    assert "1998" in line


def test_bucketed_join_has_one_exchange(t, no_broadcast):
    text = plan(ENTRIES["j12_bucketed"].build(t)).split("(1) Scan")[0]
    assert "SortMergeJoin" in text and text.count("Exchange") == 1  # the final aggregate's


def test_running_total_shuffles_rows_once(t, no_broadcast):
    text = plan(ENTRIES["w07_running_total"].build(t)).split("(1) Scan")[0]
    left = text.split("SortMergeJoin")[1].split("Scan parquet")[0]
    assert left.count("Exchange") == 1


@pytest.mark.parametrize("name", ["w09_rolling_calendar_30_days", "w09_rolling_hour", "m06_fraud_velocity", "m09_fraud_score", "m10_velocity_offenders"])
def test_rolling_windows_have_no_range_frame(t, name):
    text = plan(ENTRIES[name].build(t))
    assert "RangeFrame" not in text and "RowFrame, unboundedpreceding" in text


def test_rolling_sums_move_the_rows_once(t, no_broadcast):
    text = plan(ENTRIES["w09_rolling_hour"].build(t)).split("(1) Scan")[0]
    left = text.split("SortMergeJoin")[1].split("Scan parquet")[0]
    assert left.count("Exchange") == 1


def test_top_n_limits_before_the_shuffle(t):
    top = ordered.top_n(t.orders, ["o_orderstatus"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    text = plan(top).split("(1) Scan")[0]
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_global_top_k_does_not_sort_everything(t):
    assert "TakeOrderedAndProject" in plan(ENTRIES["t02_global_top_k"].build(t))


def test_small_merge_source_leaves_the_target_in_place(t):
    text = plan(ENTRIES["d01_merge_small_source"].build(t)).split("(1) Scan")[0]
    assert "BroadcastHashJoin LeftOuter" in text and "FullOuter" not in text


def test_partial_aggregation(t):
    text = plan(ENTRIES["a20_partial_final_aggregate"].build(t)).split("(1) Scan")[0]
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_no_local_checkpoint_or_rdd_in_the_library():
    import pathlib

    own = [p for p in pathlib.Path("lakeloom").rglob("*.py") if "llm" not in p.parts]
    source = "\n".join(p.read_text() for p in own)
    for word in ("localCheckpoint", ".rdd", "toPandas", ".collect()", "parallelize"):
        assert word not in source


def test_written_tables_go_to_the_shared_folder(spark):
    assert workspace(spark, "x").startswith(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:").rsplit("/", 1)[0])


def test_sketch_is_not_kept_for_each_identifier(spark):
    """Beside a distinct count, Spark groups all other aggregates by the counted column too."""
    folder = workspace(spark, "sketch")
    ids = spark.range(3_000).selectExpr("id % 2000 AS event_id", "IF(id % 4 = 0, NULL, CAST(id % 3 AS STRING)) AS event_type")
    ids.write.parquet(f"{folder}/events.parquet")
    df = ENTRIES["a03_approx_count_distinct"].build(Tables(spark, folder))
    keyed = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "event_id#" in x.split("functions=")[0] and "Aggregate" in x]
    assert keyed and not any("approx_count_distinct" in x for x in keyed)
    assert sorted(map(str, df.collect())) == sorted(f"Row(event_type={t!r}, within_bound=True)" for t in ("0", "1", "2", None))
