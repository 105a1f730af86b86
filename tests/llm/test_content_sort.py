import hashlib
from collections import defaultdict

import pytest

from lakeloom.llm.content_sort import content_sort_dedup, without_copies
from tests.llm.conftest import SCHEMA, by_id


def expected(rows, best):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = best(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        seen = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not seen, sha))
            seen |= i == keep
    return by_id(out)


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
def test_edge_rows(edge_docs, keep, best):
    got = by_id(tuple(r) for r in content_sort_dedup(edge_docs, keep).collect())
    assert got == expected([(r.doc_id, r.text) for r in edge_docs.collect()], best)


def test_group_over_many_partitions(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}", None, None, None) for i in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = by_id(tuple(r) for r in content_sort_dedup(docs).collect())
        assert got == expected([r[:2] for r in rows], max)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)


def test_rows_that_stay(edge_docs, no_docs):
    kept = without_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts))
    assert set(texts) == {r.text or "" for r in edge_docs.collect()}
    assert content_sort_dedup(no_docs).count() == 0
    assert without_copies(no_docs).count() == 0


def test_unknown_keep(no_docs):
    with pytest.raises(ValueError):
        content_sort_dedup(no_docs, keep="first")
