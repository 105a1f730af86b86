from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from lakeloom.llm import jaccard_join as jj
from lakeloom.llm.components import components
from lakeloom.llm.shingles import shingle_set, signature
from tests.llm import brute_force
from tests.llm.conftest import by_id


def test_edge_rows(edge_docs):
    rows = [r for r in edge_docs.collect() if r.doc_id is not None]
    got = by_id(tuple(r) for r in jj.jaccard_components(edge_docs.where("doc_id IS NOT NULL")).collect())
    assert got == by_id(brute_force.jaccard_components([(r.doc_id, r.text) for r in rows]))


def test_null_identifier_and_empty_table(edge_docs, no_docs):
    found = jj.jaccard_components(edge_docs).where("doc_id IS NULL").collect()
    assert [(r.n_shingles, r.component_id) for r in found] == [(1, None)]
    assert jj.jaccard_components(no_docs).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute_force.jaccard_components([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(tuple(r) for r in jj.jaccard_components(docs).collect()) == want


def test_one_of_each_component_stays(edge_docs, no_docs):
    kept = jj.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = [(r.doc_id, r.text) for r in edge_docs.collect() if r.doc_id is not None]
    components_ = {d: (n, c) for d, n, c in brute_force.jaccard_components(rows)}
    want = Counter(d for d, (n, c) in components_.items() if n and d == c)
    want += Counter(d for d, text in rows if not brute_force.shingles(text))
    got = Counter(r.doc_id for r in kept.collect())
    assert got.pop(None) == 1
    assert got == want
    assert jj.one_of_each(no_docs).count() == 0


def test_shared_shingles_are_found_when_frequent_ones_stay_home(monkeypatch):
    """The packed postings give every class its shared shingles, however tasks cut the rows."""
    monkeypatch.setattr(jj, "FREQUENT", 4)
    monkeypatch.setattr(jj, "FLUSH_SHINGLES", 60)
    rng = np.random.default_rng(1)
    sets = [np.unique(np.r_[rng.integers(0, 60, 12), rng.integers(1000, 10**12, 3), [7]]) for _ in range(40)]
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(range(a, b), pa.int64()), pa.array([s.tolist() for s in sets[a:b]], pa.list_(pa.int64()))],
            names=["sig", "items"],
        )
        for a, b in ((0, 15), (15, 40), (10, 20))
    ]
    rows = [r for b in (batches[:2], batches[2:]) for r in jj._postings(jj._from_sets, 7)(iter(b))]
    table = pa.Table.from_batches(rows)
    got = defaultdict(int)
    for bucket in set(table.column("bucket").to_pylist()):
        part = table.filter(pa.compute.equal(table.column("bucket"), bucket))
        sigs, ranks = jj._shared_in_bucket(part)
        assert len(sigs) == len(ranks)
        for s in sigs.tolist():
            got[s] += 1
    # Two shingles of equal name in a bucket count as one; the small numbers here have name 0.
    holders = Counter()
    for s in sets:
        holders.update({(x % 2**32 % 7, x >> 32) for x in s.tolist()})
    for i, s in enumerate(sets):
        names = [(x % 2**32 % 7, x >> 32) for x in s.tolist()]
        assert got[i] >= sum(holders[n] > 1 for n in set(names))
        assert got[i] <= len(names)


def test_short_sets_fill_their_prefix():
    for n in (1, 2, 3, 5, 17, 400):
        s = np.sort(np.random.default_rng(n).integers(-(2**62), 2**62, n))
        chosen = jj._submitted(s, 0.36)
        assert len(set(chosen.tolist())) == len(chosen) >= n - (3 * n + 3) // 4 + 1


def test_signature_names_the_set():
    assert signature(shingle_set("A b c d e f")) == signature(shingle_set("a  B c\td e f"))
    assert signature(shingle_set("a b c d e f")) != signature(shingle_set("a b c d e g"))
    assert len(shingle_set(None)) == 0 and len(shingle_set("one")) == 1


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def drifting_copies(rng, n, words, edits):
    """Copies of copies, so that links form chains and no document is near all others, and a
    group of one passage with so many edits that its members rarely link."""
    base = [f"w{rng.integers(10**9)}" for _ in range(words)]
    texts = [base]
    for _ in range(n - 1):
        text = list(texts[rng.integers(len(texts))])
        for _ in range(edits):
            text[rng.integers(len(text))] = f"e{rng.integers(10**9)}"
        texts.append(text)
    far = []
    for _ in range(n // 2):
        text = list(base)
        for at in rng.choice(words, 7 + rng.integers(3), replace=False):
            text[at] = f"f{rng.integers(10**9)}"
        far.append(text)
    return [" ".join(t) for t in texts + far]


def test_large_groups_joined_by_repeated_stars(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = drifting_copies(rng, 240, 150, 2) + drifting_copies(rng, 80, 60, 1)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(6)
    made = []
    stars = jj._star_pairs
    monkeypatch.setattr(jj, "_star_pairs", lambda *a: made.append(1) or stars(*a))
    got = sorted(tuple(r) for r in jj.jaccard_components(docs).collect())
    want = brute_force.jaccard_components(rows)
    assert got == want
    assert made and 1 < len({c for _, _, c in want}) < len(rows) / 2
