from collections import Counter

import corpus_pipeline
from lakeloom.llm import toxicity
from lakeloom.llm.catalogue import read
from lakeloom.llm.queries import learnable
from tests.llm import brute_force
from tests.llm.test_packing import check

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_code(spark):
    docs = read(spark, FOLDER, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)

    def run(name, frame):
        out = stages[name](spark, frame, FOLDER).cache()
        if name != "packing":
            assert out.columns == docs.columns
        return out, [(r.doc_id, r.text) for r in out.collect()] if name != "packing" else out.collect()

    scores = toxicity.score_toxicity(docs, learnable(docs), learnable(read(spark, FOLDER, "labels"))).collect()
    toxic = {r.doc_id for r in scores if r.score >= 0.5}
    frame, kept = run("toxicity", docs)
    assert Counter(kept) == Counter(r for r in rows if r[0] not in toxic)

    last = {text: max(i for i, t in kept if t == text) for _, text in kept}
    frame, unique = run("exact dedup", frame)
    assert Counter(unique) == Counter((i, t) for i, t in kept if last[t] == i)

    stays = {d for d, n, c in brute_force.jaccard_components(unique) if n == 0 or d == c}
    frame, apart = run("n-gram Jaccard join", frame)
    assert Counter(apart) == Counter(r for r in unique if r[0] in stays)

    frame, mixed = run("mixing", frame)
    count = lambda some: sum(len(brute_force.WORD.findall(t or "")) for _, t in some)
    assert abs(count(mixed) - count(apart)) <= len({r.source for r in docs.select("source").distinct().collect()})
    assert max(Counter(i for i, _ in mixed).values()) <= 3

    _, pieces = run("packing", frame)
    check(pieces, [t for _, t in mixed], 2048)
    ids = lambda some: sorted((r.doc_id, r.piece, r.ids_crc32) for r in some)
    assert ids(pieces) == ids(corpus_pipeline.run(spark, FOLDER).collect())


def test_edge_rows_pass_every_stage(spark, edge_docs, no_docs):
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, no_docs, FOLDER).count() == 0
        out = function(spark, edge_docs, FOLDER)
        if name != "packing":
            assert out.columns == edge_docs.columns
        assert out.count() > 0
