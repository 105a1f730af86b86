from collections import Counter

from lakeloom.llm import token_lengths as tl


def test_sums(edge_docs, no_docs):
    encode = tl._encoding(tl.default_ranks()).encode_ordinary
    lengths = [len(encode(r.text or "")) for r in edge_docs.collect()]
    sums = tl.with_sums(tl.histogram(edge_docs)).cache()
    counts = Counter(lengths)
    for r in sums.collect():
        n = r.length
        assert r.documents == counts[n] and r.tokens == n * counts[n]
        assert r.documents_below == sum(x < n for x in lengths)
        assert r.documents_from == sum(x >= n for x in lengths)
        assert r.tokens_below == sum(x for x in lengths if x < n)
        assert r.total_tokens == sum(lengths)
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
    assert sums.count() == len(counts)
    limits = [0, 1, 7, 100, 1023, 1024, 5000, 10**7]
    got = {r.context_limit: r.truncated_tokens for r in tl.truncated_totals(sums, limits).collect()}
    assert got == {n: sum(min(x, n) for x in lengths) for n in limits}
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    ordered = sorted(lengths)
    want = {s: next(x for i, x in enumerate(ordered, 1) if i >= s * len(ordered)) for s in shares}
    assert {r.share: r.length for r in tl.quantiles(sums, shares).collect()} == want
    assert tl.with_sums(tl.histogram(no_docs)).count() == 0
