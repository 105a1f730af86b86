import pytest

from conftest import rows
from lakeloom.operators.merge import Delete, Insert, Update, merge, merge_actions, upsert

SCHEMA = "txn_id bigint, customer_id string, amount double, status string"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "C001", 100.0, "PENDING"), (2, "C002", 200.0, "COMPLETED")], SCHEMA)


def source(spark, *lines):
    return spark.createDataFrame(list(lines), SCHEMA)


@pytest.mark.parametrize("limit", [None, 1000])
def test_insert(spark, target, limit):
    out = upsert(target, source(spark, (3, "C003", 300.0, "PENDING")), ["txn_id"], broadcast_rows=limit)
    assert [r[0] for r in rows(out)] == [1, 2, 3]


@pytest.mark.parametrize("limit", [None, 1000])
def test_update_and_idempotence(spark, target, limit):
    src = source(spark, (1, "C001", 100.0, "COMPLETED"))
    once = upsert(target, src, ["txn_id"], broadcast_rows=limit)
    twice = upsert(once, src, ["txn_id"], broadcast_rows=limit)
    assert (1, "C001", 100.0, "COMPLETED") in rows(once)
    assert rows(once) == rows(twice)


def test_empty_source_is_a_no_op(spark, target):
    assert rows(upsert(target, source(spark).limit(0), ["txn_id"])) == rows(target)


def test_null_keys_never_match(spark, target):
    with_null = target.unionByName(source(spark, (None, "C009", 1.0, "OLD"), (None, "C010", 2.0, "OLD")))
    out = upsert(with_null, source(spark, (None, "C009", 5.0, "NEW")), ["txn_id"])
    assert [r[1:] for r in rows(out) if r[0] is None] == [("C009", 1.0, "OLD"), ("C009", 5.0, "NEW"), ("C010", 2.0, "OLD")]


@pytest.mark.parametrize("limit", [None, 1000])
def test_ambiguous_source_fails_only_when_matched(spark, target, limit):
    twice = source(spark, (1, "C001", 1.0, "A"), (1, "C001", 2.0, "B"))
    with pytest.raises(Exception, match="several source rows"):
        upsert(target, twice, ["txn_id"], broadcast_rows=limit).collect()
    fresh = source(spark, (7, "C007", 1.0, "A"), (7, "C007", 2.0, "B"))
    assert upsert(target, fresh, ["txn_id"], broadcast_rows=limit).count() == 4


def test_first_clause_wins_and_unlisted_columns_stay(spark, target):
    src = source(spark, (1, "X", 1.0, "GONE"), (2, "X", 250.0, "NEW"), (3, "X", 5.0, "NEW"), (4, "X", 50.0, "NEW"))
    clauses = [Delete("src.status = 'GONE'"), Update("src.amount > tgt.amount", {"amount": "src.amount"}), Insert("src.amount >= 10")]
    assert rows(merge(target, src, ["txn_id"], clauses)) == [(2, "C002", 250.0, "COMPLETED"), (4, "X", 50.0, "NEW")]
    actions = merge_actions(target, src, ["txn_id"], clauses)
    assert sorted(r["_action"] for r in actions.collect()) == ["deleted", "inserted", "updated"]


def test_null_condition_is_false(spark, target):
    src = source(spark, (1, "C001", None, "X"))
    out = merge(target, src, ["txn_id"], [Update("src.amount > 0")])
    assert rows(out) == rows(target)
