"""Handlers of streams: stored schemas, upserted tables, hot keys."""

import json
import random
import time

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import workspace
from lakeloom.sources.landing import RESCUED, file_stream
from lakeloom.streaming import joins, keyed, schemas, sessions
from lakeloom.streaming.batches import append_handler
from lakeloom.streaming.run import drain, start_batches

START = T.StructType().add("id", T.LongType())


def lines(spark, *objects):
    return spark.createDataFrame([(json.dumps(o) if isinstance(o, dict) else o,) for o in objects], "value string")


def test_schema_store_is_safe_to_replay(spark):
    path = workspace(spark, "schemas")
    store = schemas.SchemaStore(spark, path, START)
    wider = T.StructType([*START, T.StructField("a", T.StringType())])
    store.save(0, START)
    store.save(3, wider)
    again = schemas.SchemaStore(spark, path, T.StructType().add("other", T.LongType()))  # a restart
    assert again.before(3) == (0, START) and again.before(4) == (1, wider)
    again.save(3, wider)  # the batch is replayed
    assert rows(again.versions(), "version", "batch_id") == [(0, -1), (1, 3)]
    assert again.latest() == wider


def test_types_of_new_fields(spark):
    df = lines(
        spark,
        {"id": 1, "n": 5, "x": 1.5, "b": True, "s": "t", "none": None, "mixed": 1},
        {"id": 2, "n": None, "x": 2, "b": False, "s": "7", "mixed": "one"},
        "no json",
        None,
    )
    found = schemas.unknown_fields(df, "value", START)
    want = {"b": "boolean", "mixed": "string", "n": "bigint", "none": "string", "s": "string", "x": "double"}
    assert {f.name: f.dataType.simpleString() for f in found} == want
    assert list(found.names) == sorted(found.names)


@pytest.mark.parametrize("mode", ["addNewColumns", "rescue", "none"])
def test_replayed_batch_stores_the_same(spark, mode):
    path = workspace(spark, "modes")
    store = schemas.SchemaStore(spark, f"{path}/schema", START)
    handle = schemas.evolving_json_handler(f"{path}/data", store, mode)
    handle(lines(spark, {"id": 1}), 0)
    for _ in range(2):
        handle(lines(spark, {"id": 2, "a": 5}, {"id": "x"}), 1)
    got = schemas.stored_rows(spark, f"{path}/data", store, mode)
    if mode == "addNewColumns":
        assert rows(got, "id", "a") == rows(spark.createDataFrame([(1, None), (2, 5), (None, None)], "id long, a long"))
        assert store.before(9)[0] == 1
    elif mode == "rescue":
        assert {r.id: r[RESCUED] for r in got.collect()} == {1: None, 2: '{"a":"5"}', None: '{"id":"x"}'}
    else:
        assert got.columns == ["id"] and got.count() == 3


def test_fail_writes_nothing_until_accepted(spark):
    path = workspace(spark, "fail")
    store = schemas.SchemaStore(spark, f"{path}/schema", START)
    handle = schemas.evolving_json_handler(f"{path}/data", store, "failOnNewColumns")
    handle(lines(spark, {"id": 1}), 0)
    with pytest.raises(ValueError, match="new columns"):
        handle(lines(spark, {"id": 2, "a": 1}), 1)
    assert schemas.stored_rows(spark, f"{path}/data", store, "failOnNewColumns").count() == 1
    store.accept(T.StructType().add("a", T.LongType()), 1)
    handle(lines(spark, {"id": 2, "a": 1}), 1)
    assert rows(schemas.stored_rows(spark, f"{path}/data", store, "failOnNewColumns"), "id", "a") == [(1, None), (2, 1)]
    with pytest.raises(ValueError, match="unknown mode"):
        schemas.evolving_json_handler(path, store, "other")(lines(spark, {"id": 1}), 2)


def table(spark, **more):
    return keyed.keyed_table(spark, workspace(spark, "keyed"), "k long, v long, at long", ["k"], [F.desc("at")], **more)


def test_many_batches_keep_few_files(spark):
    upserted, newest, most = table(spark, buckets=4, fold_every=5), {}, 0
    for b in range(60):
        batch = [((b * 7 + i) % 23, 100 * b + i, b // 2) for i in range(3)]
        for k, v, at in batch:
            newest[k] = v  # at never falls; ties go to the later batch
        upserted.upsert(spark.createDataFrame(batch, "k long, v long, at long"), b)
        if b % 10 == 9:
            most = max(most, upserted.n_files())
            assert dict(rows(upserted.rows(), "k", "v")) == newest
    # two generations of base buckets, and changes since the last fold but one
    assert most <= 2 * 4 + 2 * 5 * 3


def test_replayed_and_late_batches(spark):
    upserted = table(spark, buckets=3, fold_every=100)
    batches = [[(1, 10, 1), (2, 20, 1)], [(1, 11, 2)], [(2, 5, 0), (None, 7, 1)], [(3, 30, 9)]]
    frames = [spark.createDataFrame(b, "k long, v long, at long") for b in batches]
    for b, df in enumerate(frames[:3]):
        upserted.upsert(df, b)
    want = rows(upserted.rows())
    assert [(r[0], r[1]) for r in want] == [(1, 11), (2, 20), (None, 7)]
    upserted.fold(2)
    upserted.upsert(frames[1], 1)  # replayed after its fold
    assert rows(upserted.rows()) == want
    upserted.fold(2)  # a fold that is repeated
    upserted.upsert(frames[3], 3)
    upserted.fold(3)
    upserted.fold(3)
    assert rows(upserted.rows(), "k", "v") == [(1, 11), (2, 20), (3, 30), (None, 7)]


def test_broken_off_fold_is_not_seen(spark):
    upserted = table(spark, buckets=2, fold_every=100)
    for b in range(3):
        upserted.upsert(spark.createDataFrame([(b, b, b)], "k long, v long, at long"), b)
    # the base is written, the note of the fold is not
    wrong = spark.createDataFrame([(9, 9, 9, 0, 0)], "k long, v long, at long, _batch long, bucket int")
    wrong.write.partitionBy("bucket").parquet(f"{upserted.path}/base/upto=2")
    assert rows(upserted.rows(), "k") == [(0,), (1,), (2,)]
    upserted.fold(2)
    assert rows(upserted.rows(), "k") == [(0,), (1,), (2,)]


def test_unchanged_buckets_are_not_shuffled(spark):
    upserted = table(spark, buckets=8, fold_every=100)
    upserted.upsert(spark.range(200).selectExpr("id AS k", "id AS v", "0 AS at"), 0)
    upserted.fold(0)
    assert "Exchange" not in upserted.rows()._jdf.queryExecution().toString()
    upserted.upsert(spark.createDataFrame([(5, 0, 1)], "k long, v long, at long"), 1)
    read = upserted.rows()
    touched = [line for line in read._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line]
    assert any("bucket" in line for line in touched)
    assert dict(rows(read, "k", "v"))[5] == 0 and read.count() == 200


def test_hot_key_is_dealt_over_all_partitions(spark):
    keep = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for name, value in zip(keep, ("false", "-1", "8")):
        spark.conf.set(name, value)
    try:
        events = spark.range(12_000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997).alias("k"))
        static = spark.range(0, 1200, 2).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
        path = workspace(spark, "hot")
        handle = joins.HotEnrichment(f"{path}/data", f"{path}/state", static, "k")
        assert rows(handle.hot_keys(events), "key") == [(1,)]
        plain = joins.enrich(events, static, "k")
        dealt = joins.enrich_hot(events, static, "k", [1], 32)
        assert rows(dealt, "id", "k", "name") == rows(plain, "id", "k", "name")

        def largest(df):
            sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
            return sizes[-1] / sizes[len(sizes) // 2]

        assert largest(dealt) < 2 < largest(plain)
        for b in (0, 1):
            handle(events, b)
            handle(events, b)  # replayed
        assert spark.read.parquet(f"{path}/data").count() == 24_000
        assert rows(spark.read.parquet(f"{path}/state"), "key", "batch_id") == [(1, 0), (1, 1)]
    finally:
        for name, value in keep.items():
            spark.conf.set(name, value)


def pieces_of(events, gap):
    """The sessions of ``(customer, micros, amount)`` events, one customer after the other."""
    found = {}
    for customer, at, amount in sorted(events, key=lambda e: e[:2]):
        own = found.setdefault(customer, [])
        if own and at - own[-1][1] < gap:
            own[-1] = [own[-1][0], at, own[-1][2] + 1, own[-1][3] + amount]
        else:
            own.append([at, at, 1, amount])
    return sorted((c, *p) for c, own in found.items() for p in own)


def as_events(events):
    customers, at, amounts = zip(*events, strict=True) if events else ((), (), ())
    return pd.DataFrame(
        {"customer_id": pd.Series(customers, dtype=object), "event_timestamp": pd.to_datetime(pd.Series(at, dtype="int64"), unit="us"), "amount": pd.Series(amounts, dtype=float)}
    )


def test_pieces_of_sessions(spark):
    made = random.Random(5)
    events = [(f"c{made.randrange(40)}", made.randrange(3000), float(made.randrange(9))) for _ in range(900)]
    batches = [events[:1], events[1:500], [], events[500:]]
    out = list(sessions.fragments(iter(map(as_events, batches)), 25))
    got = [sorted(map(tuple, pdf[["customer_id", "start_us", "last_us", "events", "amount"]].to_numpy().tolist())) for pdf in out]
    assert got == [pieces_of(b, 25) for b in batches]
    assert all((pdf["last_at"] == pd.to_datetime(pdf["last_us"], unit="us")).all() for pdf in out)
    unknown = as_events([("a", 1, 2.0), ("a", 2, float("nan"))])
    assert next(sessions.fragments(iter([unknown]), 25))["amount"].tolist() == [2.0]


def test_pieces_of_many_customers_take_no_time_each(spark):
    batch = as_events([(f"c{i}", 7 * i, 1.0) for i in range(30_000)])
    began = time.perf_counter()
    assert sum(map(len, sessions.fragments(iter([batch]), 25))) == 30_000
    assert time.perf_counter() - began < 8


@pytest.mark.parametrize("slots", [1, 2, 4096])
def test_customers_of_a_slot_keep_their_own_sessions(spark, slots):
    """Three batches, the second without ``b``: only customers with new events are reported as active."""
    path = workspace(spark, "slots")
    schema = "customer_id string, event_timestamp timestamp, amount double"
    parts = [
        [("a", 0, 1.0), ("a", 20, 2.0), ("b", 5, 4.0), (None, 5, 9.0), ("a", 70, 3.0)],
        [("a", 90, 5.0)],
        [("c", 600, 6.0), ("b", None, 9.0)],
    ]
    for part in parts:
        made = spark.createDataFrame(part, "customer_id string, minute int, amount double")
        made = made.selectExpr("customer_id", "timestamp_seconds(minute * 60) AS event_timestamp", "amount")
        made.coalesce(1).write.mode("append").parquet(f"{path}/landing")
        rows_in = file_stream(spark, f"{path}/landing", T.StructType.fromDDL(schema))
        tracked = sessions.track_sessions(rows_in, "10 minutes", 30, slots)
        drain(start_batches(tracked, append_handler(f"{path}/data"), f"{path}/checkpoint", mode="update"))
    out = spark.read.parquet(f"{path}/data").selectExpr(
        "customer_id", "unix_seconds(session_start) DIV 60 AS s", "unix_seconds(last_event_time) DIV 60 AS e", "event_count", "total_amount", "session_status"
    )
    assert rows(out) == sorted(
        [
            ("a", 0, 20, 2, 3.0, "ACTIVE"), ("a", 70, 70, 1, 3.0, "ACTIVE"), ("b", 5, 5, 1, 4.0, "ACTIVE"),
            ("a", 0, 20, 2, 3.0, "TIMED_OUT"), ("b", 5, 5, 1, 4.0, "TIMED_OUT"),
            ("a", 70, 90, 2, 8.0, "ACTIVE"), ("c", 600, 600, 1, 6.0, "ACTIVE"), ("a", 70, 90, 2, 8.0, "TIMED_OUT"),
        ],
        key=lambda t: tuple(map(str, t)),
    )


def test_busy_customers_are_joined_in_growing_steps():
    chunk = pd.DataFrame({"customer_id": "a", "start_us": range(9_000), "last_us": range(9_000), "events": 1, "amount": 1.0})
    steps = [len(found["a"]) for found in sessions.by_customer(iter([chunk] * 12))]
    assert steps == [18_000, 27_000, 45_000, 18_000]
