import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import curriculum
from tests.llm.brute_force import WORD


def water_filled(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        for s in full or open_:
            target[s] = most * sizes[s] if full else level * weight[s]
        if not full:
            break
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k:02d}": rng.choice([0, 1, 5, 100, 10_000, 10**7]) for k in range(12)} | {None: 40}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in curriculum.targets(df).collect()}
    want = water_filled(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s])


def test_demand_inverse(spark):
    for start in curriculum.START_FACTORS:
        times = [k / 20 for k in range(21)]
        shares = [start * t - (start - 1) * t * t for t in times]
        df = spark.createDataFrame([(s,) for s in shares], "s double")
        got = [r[0] for r in df.select(curriculum.demand_inverse(F.col("s"), F.lit(start))).collect()]
        assert got == pytest.approx(times)


def test_edge_rows(edge_docs, no_docs):
    rows = curriculum.plan(edge_docs).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size and r.taken == r.whole * r.size + r.cut
        assert (r.first_position is None) == (r.taken == 0)
        assert r.first_position is None or 0 <= r.first_position <= 1
    assert sorted(r.size for r in rows) == sorted(len(WORD.findall(r.text or "")) for r in edge_docs.collect())
    want = water_filled(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) < 1 + 1e-6 * target[s]
    again = sorted(str(tuple(r)) for r in curriculum.plan(edge_docs).collect())
    assert again == sorted(str(tuple(r)) for r in rows)
    assert curriculum.plan(no_docs).count() == 0


def test_mixed_documents(edge_docs, no_docs):
    mixed = curriculum.mixed_documents(edge_docs)
    assert mixed.columns == edge_docs.columns
    rows = mixed.collect()
    words = sum(len(WORD.findall(r.text)) for r in rows)
    assert words == sum(r.taken for r in curriculum.plan(edge_docs).collect())
    whole = {(r.doc_id, r.text) for r in edge_docs.collect()}
    cut = [r for r in rows if (r.doc_id, r.text) not in whole]
    assert len(cut) <= 8
    for r in cut:
        assert any(t and t.startswith(r.text) and re.search(r"[^\x20\x09-\x0D]$", r.text) for i, t in whole if i == r.doc_id)
    assert curriculum.mixed_documents(no_docs).count() == 0


def test_schedules_shift_sources_over_time(spark):
    """The source that falls off over time comes earlier on average than the one that rises."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "'a b c d e' AS text", "concat('s', id % 3) AS source")
    placed = curriculum.plan(docs).where("taken > 0").groupBy("source").agg(F.avg("first_position").alias("p"))
    early = {r.source: r.p for r in placed.collect()}
    assert early["s0"] < early["s2"]
