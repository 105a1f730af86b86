"""Small fixtures with results worked out by hand."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import calendar, cleaning, masking, text
from lakeloom.operators import access, aggregates, incremental, joins, layout, quality, schema, sequences
from lakeloom.operators.ordered import latest_per_key, running_total
from lakeloom.session import shared_root, workspace
from lakeloom.sources import files, jdbc, landing, messages
from lakeloom.streaming import batches
from lakeloom.streaming.sessions import join_pieces

MODES = ("CARD", "UPI", "NETBANKING", "NEFT", "RTGS", "IMPS", "WALLET")


@pytest.fixture(scope="module")
def transactions(spark):
    return spark.createDataFrame(
        [
            (1, "2024-01-15", "C001", 150.0, "CARD", "COMPLETED"),
            (2, "2024-01-15", "C002", 200.0, "UPI", "COMPLETED"),
            (3, "2024-01-15", "C003", -50.0, "CARD", "COMPLETED"),
            (4, "2024-01-15", "C004", None, "CARD", "COMPLETED"),
            (5, "2024-01-15", None, 100.0, "UPI", "COMPLETED"),
            (6, "2024-01-15", "C006", 100.0, "BARTER", "COMPLETED"),
            (7, "2024-01-16", "C001", 300.0, "NEFT", "PENDING"),
        ],
        "txn_id bigint, txn_date string, customer_id string, amount double, payment_mode string, status string",
    )


def test_clean_keeps_three(transactions):
    clean = quality.clean_transactions(transactions, MODES)
    assert [r[0] for r in rows(clean)] == [1, 2, 7]
    assert clean.schema == transactions.schema
    assert quality.clean_transactions(transactions.limit(0), MODES).isEmpty()


def test_amount_boundaries(spark):
    df = spark.createDataFrame([(99.99,), (100.0,), (999.99,), (1000.0,), (10000.0,), (None,)], "a double")
    got = [r[0] for r in df.select(cleaning.amount_category(F.col("a"))).collect()]
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "PREMIUM", None]


def test_latest_kept(spark):
    df = spark.createDataFrame([(1, "PENDING", 1), (1, "COMPLETED", 2), (2, "PENDING", 1)], "id int, status string, at int")
    assert rows(latest_per_key(df, ["id"], [F.desc("at")]), "id", "status") == [(1, "COMPLETED"), (2, "PENDING")]


def test_running_total_per_customer(spark):
    df = spark.createDataFrame([("C001", 1, 100.0), ("C001", 2, 200.0), ("C001", 3, 150.0), ("C002", 1, 300.0)], "c string, d int, amount double")
    assert rows(running_total(df, ["c"], [F.col("d")], "amount"), "c", "running_total") == [("C001", 100.0), ("C001", 300.0), ("C001", 450.0), ("C002", 300.0)]


def test_money_and_numbers(spark):
    df = spark.createDataFrame([("₹1,234.50",), ("$7",), ("n/a",), ("",), (None,), ("NaN",), ("1d",)], "s string")
    assert [r[0] for r in df.select(cleaning.to_money(F.col("s"))).collect()] == [1234.5, 7.0, None, None, None, None, None]


def test_join_set(spark):
    customers = spark.createDataFrame([("C001",), ("C002",), ("C003",), ("C004",)], "customer_id string")
    txns = spark.createDataFrame([(1, "C001"), (2, "C001"), (3, "C002"), (4, "C999")], "txn_id int, customer_id string")
    sizes = {how: customers.join(txns, "customer_id", how).count() for how in ("inner", "left", "right", "full", "left_semi", "left_anti")}
    assert sizes == {"inner": 3, "left": 5, "right": 4, "full": 6, "left_semi": 2, "left_anti": 2}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 40).alias("k"))
    right = spark.range(0, 30).select(F.col("id").alias("k"), F.explode(F.array(F.lit("x"), F.lit("y"))).alias("w"))
    assert rows(joins.salted_join(left, right, "k", ["id"], 4, how=how)) == rows(left.join(right, "k", how).select("k", "id", *([] if how == "left_semi" else ["w"])))


def test_hot_keys_are_few_by_construction(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    assert rows(joins.hot_keys(df, "k", 0.1)) == [(0, 500)]


def test_broadcast_only_when_small(spark):
    small, large = spark.range(10), spark.range(1000)
    assert "ResolvedHint" in joins.broadcast_if_small(small, 100)._jdf.queryExecution().analyzed().toString()
    assert joins.broadcast_if_small(large, 100) is large


def test_as_of_bounds_and_missing_history(spark):
    day = lambda n: dt.date(2024, 1, n)
    history = spark.createDataFrame([("A", 1, day(2), day(5)), ("A", 2, day(5), None)], "k string, v int, valid_from date, valid_to date")
    facts = spark.createDataFrame([("A", day(1)), ("A", day(2)), ("A", day(5)), ("A", day(29)), ("B", day(3))], "k string, at date")
    want = [("A", day(1), None), ("A", day(2), 1), ("A", day(29), 2), ("A", day(5), 2), ("B", day(3), None)]
    assert sorted(map(str, rows(joins.as_of_join(facts, history, "k", "at", ["v"])))) == sorted(map(str, want))
    sliced = joins.as_of_join(facts, history, "k", "at", ["v"], slice_days=3, horizon=F.lit(day(10)))
    assert sorted(map(str, rows(sliced))) == sorted(map(str, want))


def test_checks_partition_the_input(transactions):
    rules = quality.transaction_rules("2024-01-20")
    df = transactions.withColumns({"merchant_id": F.lit("M"), "txn_date": F.to_date("txn_date")})
    checked = quality.run_checks(df, rules)
    passed, failed = [r[0] for r in rows(checked.passed, "txn_id")], [r[0] for r in rows(checked.failed, "txn_id")]
    assert (passed, failed) == ([1, 2, 7], [3, 4, 5, 6])
    reasons = dict(rows(checked.failed, "txn_id", "_dq_failure_reason"))
    assert reasons[4] == "TXN_002:amount_not_null" and reasons[5].startswith("TXN_003")
    assert rows(quality.quality_report(checked.results), "overall_status") == [("FAILED",)]


def test_expectations_count_on_the_way(transactions):
    kept, seen = quality.expect(transactions, {"positive": "amount > 0"}, "drop", "fixture")
    assert kept.count() == 5
    assert seen.get == {"rows": 7, "positive": 2}
    failing, _ = quality.expect(transactions, {"positive": "amount > 0"}, "fail", "fixture2")
    with pytest.raises(Exception, match="expectation failed"):
        failing.collect()


def test_dead_letters_resolve_once(transactions):
    letters = quality.dead_letters(transactions, "p", "b", F.lit("BAD"), F.lit(dt.datetime(2024, 1, 1)))
    again = quality.dead_letters(transactions, "p", "b", F.lit("BAD"), F.lit(dt.datetime(2024, 1, 2)))
    assert rows(letters, "record_id") == rows(again, "record_id")
    one = letters.limit(1).select("record_id")
    done = quality.mark_resolved(letters, one.unionByName(one))
    assert quality.unresolved(done).count() == 6


def test_gate_stops_above_half(spark):
    df = spark.createDataFrame([(100, 4), (100, 6), (100, 51)], "t int, r int")
    gated = df.withColumn("gate", quality.rejection_gate(F.col("t"), F.col("r")))
    assert [r["gate"] for r in gated.collect()] == ["OK", "WARNING", "FAILED"]
    with pytest.raises(Exception, match="rejection rate"):
        quality.enforce_gate(gated).collect()


def test_constraints_reject_the_write(spark, transactions):
    path = workspace(spark, "rejected")
    with pytest.raises(Exception, match="positive"):
        schema.checked_write(transactions, {"positive": "amount > 0"}).write.parquet(path)


def test_schema_mismatch_is_listed(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    expected = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    assert [p[:2] for p in schema.schema_differences(expected, df.schema)] == [("a", "type_changed"), ("b", "extra"), ("c", "missing")]
    with pytest.raises(ValueError):
        schema.enforce_schema(df, expected)


def test_corrupt_rows(spark):
    path = workspace(spark, "csv")
    spark.createDataFrame([("1,2.5",), ("x,oops",), ("3,4.5",)], "value string").write.text(path)
    read = files.read_csv(spark, path, f"id bigint, v double, {files.CORRUPT} string", header="false", columnNameOfCorruptRecord=files.CORRUPT)
    good, bad = files.split_corrupt(read)
    assert rows(good) == [(1, 2.5), (3, 4.5)] and [r[2] for r in rows(bad)] == ["x,oops"]
    with pytest.raises(Exception):
        files.read_csv(spark, path, "id bigint, v double", header="false", mode="FAILFAST").collect()


def test_missing_source_is_none(spark):
    assert files.read_if_present(spark, workspace(spark, "nowhere"), "a int") is None


def test_rescue_and_evolution(spark):
    known = T.StructType([T.StructField("a", T.LongType())])
    df = spark.createDataFrame([(1, "x")], "a bigint, extra string")
    fitted, kept = landing.conform(df, known, "rescue")
    assert rows(fitted) == [(1, '{"extra":"x"}')] and kept == known
    widened, wider = landing.conform(df, known, "addNewColumns")
    assert widened.columns == ["a", "extra"] and wider.names == ["a", "extra"]
    with pytest.raises(ValueError):
        landing.conform(df, known, "failOnNewColumns")
    assert landing.conform(df, known, "none")[0].columns == ["a"]


def test_message_options_and_offsets():
    made = messages.stream_options("b:9092", ["t", "u"], max_per_trigger=5, fail_on_data_loss=False)
    assert made["subscribe"] == "t,u" and made["failOnDataLoss"] == "false" and made["maxOffsetsPerTrigger"] == "5"
    assert messages.offset_json({"t": {0: 5}}) == '{"t": {"0": 5}}'


def test_jdbc_options():
    made = jdbc.read_options("jdbc:x", "t", "id", 1, 100, 4)
    assert made["numPartitions"] == "4" and made["lowerBound"] == "1"
    assert jdbc.since_query("t", "updated_at", "TIMESTAMP '2024-01-01'") == "(SELECT * FROM t WHERE updated_at >= TIMESTAMP '2024-01-01') src"


def test_watermark_ties_are_read_again(spark):
    source = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 9, "c")], "id int, at int, v string")
    target = spark.createDataFrame([(1, 10, "a")], "id int, at int, v string")
    load = incremental.incremental_load(source, target, ["id"], "at", 10)
    assert rows(load.target) == [(1, 10, "a"), (2, 10, "b")]
    assert rows(load.stats, "records_read", "new_watermark", "status") == [(2, 10, "SUCCESS")]
    nothing = incremental.incremental_load(source, target, ["id"], "at", 99)
    assert rows(nothing.stats, "records_read", "new_watermark", "status") == [(0, 99, "SKIPPED")]


def test_access_needs_a_group(spark):
    df = spark.createDataFrame([("a@b.com", "IN"), ("c@d.com", "US")], "email string, region string")
    policy = access.Policy({"email": (("compliance",), masking.mask_email(F.col("email")))}, {"india": "region = 'IN'"})
    assert access.secure_view(df, policy, set()).isEmpty()
    assert rows(access.secure_view(df, policy, {"india"})) == [("a@b****@****.com", "IN")]
    assert rows(access.secure_view(df, policy, {"india", "compliance"})) == [("a@b.com", "IN")]


def test_pii_signs_occur_in_every_match():
    for kind, example in {"email": "a.b@c.org", "phone": "555-123-4567", "ipv4": "10.0.0.1"}.items():
        assert masking.PII_SIGNS[kind] in example


def test_fiscal_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 31),), (dt.date(2024, 4, 1),)], "d date")
    assert rows(df.select(calendar.fiscal_year(F.col("d")), calendar.fiscal_quarter(F.col("d")))) == [(2023, "Q4"), (2024, "Q1")]


def test_ngrams_of_short_text(spark):
    df = spark.createDataFrame([("a b c",), ("a",), ("",)], "s string")
    got = [r[0] for r in df.select(text.ngrams(text.words(F.col("s")), 2)).collect()]
    assert got == [["a b", "b c"], [], []]


def test_session_pieces_in_any_order():
    pieces = [[0, 10, 2, 1.0], [15, 20, 1, 1.0], [100, 110, 3, 2.0], [8, 16, 2, 1.0]]
    assert join_pieces(pieces, 30) == join_pieces(pieces[::-1], 30) == [[0, 20, 5, 3.0], [100, 110, 3, 2.0]]


def test_lists_stay_bounded(spark):
    df = spark.range(25).withColumn("k", F.lit("hot"))
    lists = aggregates.collect_chunks(df, ["k"], F.col("id"), [F.col("id")], size=10, block=F.floor(F.col("id") / 7))
    got = rows(lists, "chunk", "items")
    assert [len(items) for _, items in got] == [10, 10, 5] and sum((items for _, items in got), []) == list(range(25))


def test_hierarchy_drops_no_level(spark):
    df = spark.range(13).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("p"), F.col("id").cast("string").alias("n"))
    assert sequences.hierarchy(df, "id", "p", "n").count() == 13
    assert sequences.hierarchy(df, "id", "p", "n", max_depth=13).count() == 13
    with pytest.raises(ValueError):
        sequences.hierarchy(df, "id", "p", "n", max_depth=12)
    cycle = df.union(spark.createDataFrame([(3, 12, "3")], "id long, p long, n string"))
    with pytest.raises(ValueError):
        sequences.hierarchy(cycle, "id", "p", "n")


def tree(spark, pairs):
    return spark.createDataFrame([(n, p, f"n{n}") for n, p in pairs], "id long, p long, n string")


def test_hierarchy_of_many_levels(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("p"), F.lit("x").alias("n"))
    found = sequences.hierarchy(df, "id", "p", "n", separator="")
    assert found.count() == 5000
    assert found.where("level <> node + 1 OR path <> repeat('x', level)").isEmpty()


def test_hierarchy_with_several_parents_and_lost_ones(spark):
    # 3 is reached on one level over 1 and 2, 4 on two levels; nothing reaches 8 and 9.
    df = tree(spark, [(0, None), (1, 0), (2, 0), (3, 1), (3, 2), (4, 3), (4, 0), (8, 99), (9, 8)])
    got = rows(sequences.hierarchy(df, "id", "p", "n"), "node", "level", "path")
    want = [(0, 1, "n0"), (1, 2, "n0 > n1"), (2, 2, "n0 > n2"), (4, 2, "n0 > n4")]
    for via in (1, 2):
        want += [(3, 3, f"n0 > n{via} > n3"), (4, 4, f"n0 > n{via} > n3 > n4")]
    assert got == sorted(want, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("cycle", [[(5, 5)], [(5, 6), (6, 5)], [(5, 6), (6, 7), (7, 5), (8, 7)]])
def test_hierarchy_with_a_cycle_raises_early(spark, cycle):
    wide = [(0, None)] + [(n, 0) for n in range(100, 400)]
    with pytest.raises(ValueError, match="cycle"):
        sequences.hierarchy(tree(spark, wide + cycle), "id", "p", "n")


def test_empty_hierarchy(spark):
    assert sequences.hierarchy(tree(spark, [(1, 1)]).where("id > 1"), "id", "p", "n").count() == 0


def test_csv_reads_long_fields_and_comment_signs(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1," + "x" * 150_000 + "\n#2,y\n")
    got = files.read_csv(spark, str(tmp_path / "a.csv"), "id string, v string").collect()
    assert [(r.id, len(r.v)) for r in got] == [("1", 150_000), ("#2", 1)]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_hot_split_join_equals_the_plain_join(spark, how):
    left = spark.createDataFrame([(1, i) for i in range(90)] + [(i, i) for i in range(2, 12)] + [(None, -1)], "k long, a long")
    right = spark.createDataFrame([(1, "hot"), (3, "three"), (99, "lonely"), (None, "null")], "k long, b string")
    split, plain = joins.hot_split_join(left, right, "k", 0.2, how), left.join(right, "k", how)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_size_is_measured_without_a_funnel(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n long")
    assert joins.measured_size(df) == (2, 34)
    assert joins.measured_size(df.limit(0)) == (0, 0)


def test_rows_without_watermark_are_handed_back(spark):
    source = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id long, at long")
    load = incremental.incremental_load(source, source.limit(0), ["id"], "at", 4)
    assert rows(load.stats, "records_read", "records_without_watermark") == [(2, 1)]
    assert rows(load.without_watermark, "id") == [(2,)]
    first = incremental.incremental_load(source, source.limit(0), ["id"], "at", None)
    assert rows(first.stats, "records_read", "records_without_watermark") == [(3, 0)]


def test_compaction_keeps_rows(spark):
    small, large = workspace(spark, "small"), workspace(spark, "large")
    spark.range(100).repartition(10).write.parquet(small)
    assert layout.compact(spark, small, large, 10**9) == 1
    assert rows(spark.read.parquet(large)) == rows(spark.range(100))


def test_cluster_must_name_a_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "yarn", "a"

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(RuntimeError):
        shared_root(Session())


def test_z_value_interleaves_quantile_numbers(spark):
    df = spark.range(64).select(F.col("id").alias("a"), (63 - F.col("id")).alias("b"))
    got = {r["a"]: r["_z"] for r in layout.z_value(df, ["a", "b"], bits=3).collect()}
    bounds = lambda v: sum(v > (i * 64 // 8) - 1 for i in range(1, 8))
    for a, z in got.items():
        qa, qb = bounds(a), bounds(63 - a)
        assert z == sum(((qa >> k) & 1) << (2 * k) | ((qb >> k) & 1) << (2 * k + 1) for k in range(3))


def test_whole_quotient_of_large_numbers(spark):
    from lakeloom.operators.ordered import _whole

    day = 86_400_000_000
    df = spark.createDataFrame([(20_000 * day - 1,), (20_000 * day,), (-1,)], "n bigint")
    assert [r[0] for r in df.select(_whole(F.col("n"), day)).collect()] == [19_999, 20_000, -1]


def test_folded_batches_keep_the_table(spark):
    path = workspace(spark, "upserts")
    for batch_id in range(5):
        rows_ = [(k, f"b{batch_id}") for k in range(batch_id, 6)]
        batches.write_batch(spark.createDataFrame(rows_, "k long, v string"), path, batch_id)
    before = rows(batches.current_rows(spark, path, ["k"]))
    batches.fold_batches(spark, path, ["k"], 3)
    assert rows(batches.current_rows(spark, path, ["k"])) == before
    assert {r.batch_id for r in spark.read.parquet(path).select("batch_id").distinct().collect()} == {3, 4}
    batches.fold_batches(spark, path, ["k"], 3)
    assert rows(batches.current_rows(spark, path, ["k"])) == before
