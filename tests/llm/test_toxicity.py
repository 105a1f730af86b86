import itertools

import numpy as np
import pytest

from lakeloom.llm import toxicity
from lakeloom.llm.queries import op4
from tests.llm.conftest import SCHEMA

RNG = np.random.default_rng(4)


def enumerated(unary, pairs):
    total, toxic = 0.0, np.zeros(len(unary))
    for tags in itertools.product((0, 1), repeat=len(unary)):
        score = sum(u for u, t in zip(unary, tags) if t) + sum(pairs[a][b] for a, b in zip(tags, tags[1:]))
        total += np.exp(score)
        toxic += np.array(tags) * np.exp(score)
    return toxic / total


def test_marginals_against_enumeration():
    lengths = np.array([3, 0, 1, 7, 5])
    unary, pairs = RNG.normal(0, 2, 16), RNG.normal(0, 1, (2, 2))
    p = toxicity.marginals(unary, lengths, pairs)
    at = 0
    for n in lengths:
        if n:
            assert p[at : at + n] == pytest.approx(enumerated(unary[at : at + n], pairs))
        at += n


@pytest.mark.parametrize("chain", [1, 2, 3, 64])
def test_texts_are_whole_chains(monkeypatch, chain):
    monkeypatch.setattr(toxicity, "CHAIN", chain)
    lengths = np.array([0, 3, 10, 1, 0, 7, 12, 2, 4])
    unary, pairs = RNG.normal(0, 2, int(lengths.sum())), RNG.normal(0, 2, (2, 2))
    p = toxicity.marginals(unary, lengths, pairs, whole=True)
    at = 0
    for n in lengths:
        if n:
            assert p[at : at + n] == pytest.approx(enumerated(unary[at : at + n], pairs))
        at += n


def test_blocks_of_a_long_text_agree_with_one_long_chain(monkeypatch):
    lengths = np.array([5000, 64, 65, 128, 1])
    unary, pairs = RNG.normal(0, 8, int(lengths.sum())), np.array([[6.0, -6.0], [-5.0, 6.0]])
    blocks = toxicity.marginals(unary, lengths, pairs, whole=True)
    cut = toxicity.marginals(unary, lengths, pairs)
    monkeypatch.setattr(toxicity, "CHAIN", 10_000)
    assert blocks == pytest.approx(toxicity.marginals(unary, lengths, pairs))
    assert blocks != pytest.approx(cut)


def test_expected_pairs_sum_to_the_links_of_all_chains():
    lengths = np.array([toxicity.CHAIN * 2 + 5, 1, 0, 9])
    unary = RNG.normal(0, 1, int(lengths.sum()))
    _, expected = toxicity.marginals(unary, lengths, RNG.normal(0, 1, (2, 2)), counts=True)
    links = sum(min(toxicity.CHAIN, n - k) - 1 for n in lengths for k in range(0, n, toxicity.CHAIN))
    assert expected.sum() == pytest.approx(links)


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = [r for r in op4(spark, folder).join(labels, "doc_id").collect() if r.held_out]
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert np.mean(toxic) >= 0.85
    assert np.mean(clean) <= 0.01


def test_edge_rows_and_offsets(spark, edge_docs, no_docs):
    bad = [(1000 + k, f"Word after word, you IDIOT scum number {k} idiot!", "en", "a", 40) for k in range(30)]
    good = [(2000 + k, f"Word after word, you kind person number {k} friend!", "en", "a", 40) for k in range(30)]
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(bad + good, SCHEMA))
    labels = spark.createDataFrame(
        [(r[0], 1, 1) for r in bad] + [(r[0], 1, 0) for r in good] + [(None, 0, 1), (1, 1, None), (1000, 1, 0), (99999, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = toxicity.score_toxicity(docs, docs, labels).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id and 1000 <= r.doc_id < 1030:
            assert r.score >= 0.5
            found = {texts[r.doc_id][s.start : s.end] for s in r.spans}
            assert found & {"IDIOT scum", "IDIOT", "idiot"}
        else:
            assert r.score < 0.5, r
    kept = toxicity.without_toxic(docs, docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 30
    assert toxicity.score_toxicity(no_docs, no_docs, labels).count() == 0
    unlabelled = toxicity.score_toxicity(docs, docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in unlabelled] == [0.0]
