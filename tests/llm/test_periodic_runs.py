import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm.periodic_runs import Grammar, find_runs, periodic_runs
from lakeloom.llm.queries import QUERIES
from tests.llm.brute_force import WORD
from tests.llm.conftest import by_id

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words, least=12):
    """All runs by comparing the words of every period; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def laid_out(sequences):
    """As the operator lays texts side by side: symbols, starts, sizes, number of letters."""
    sequences = sorted((s for s in sequences if s), key=len, reverse=True)
    letters = 1 + max(max(s) for s in sequences)
    out, starts = [letters], []
    for k, s in enumerate(sequences):
        starts.append(len(out))
        out += [*s, letters + 1 + k]
    return np.array(out), np.array(starts), np.array([len(s) for s in sequences]), letters, sequences


symbols = st.lists(st.integers(0, 2), min_size=1, max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(symbols, min_size=1, max_size=4), st.integers(2, 12))
def test_runs_of_random_sequences(sequences, least):
    array, starts, sizes, letters, ordered = laid_out(sequences)
    runs = find_runs(array, starts, sizes, letters, least)
    got = [[] for _ in ordered]
    for s, e, q in runs.tolist():
        k = int(np.searchsorted(starts, s, "right")) - 1
        got[k].append((s - starts[k], e - s, q))
    assert got == [plain_runs(s, least) for s in ordered]


@settings(max_examples=100, deadline=None)
@given(symbols, st.integers(1, 6))
def test_extensions_against_plain_comparison(sequence, times):
    sequence = sequence * times
    array, starts, _, letters, _ = laid_out([sequence])
    n = len(sequence)
    p, q = (x.ravel() for x in np.meshgrid(np.arange(1, n + 1), np.arange(1, n + 1)))
    p, q = p[p != q], q[p != q]
    grammar = Grammar(array, letters)
    for way in (1, -1):
        got = grammar.extension(p, q, way)
        for a, b, k in zip(p.tolist(), q.tolist(), got.tolist()):
            m = 0
            while array[a + way * m] == array[b + way * m]:
                m += 1
            assert k == m


def test_long_repetition_is_extended_in_few_rounds():
    rng = random.Random(3)
    base = [rng.randrange(50) for _ in range(701)]
    array, starts, sizes, letters, _ = laid_out([base * 20, [7] * 5000])
    assert len(Grammar(array, letters).rounds) < 150
    assert find_runs(array, starts, sizes, letters).tolist() == [[1, 14021, 701], [14022, 19022, 1]]


def as_tuple(row):
    return (row.doc_id, row.n_words, [tuple(r) for r in row.runs], row.collapsed)


@pytest.mark.parametrize("flush", [1, 200_000])
def test_edge_rows(spark, edge_docs, no_docs, flush):
    more = spark.createDataFrame(
        [(900, "a " * 40 + "b"), (901, "x y\tz\n" * 9), (902, "a b a b a b a b a b a b a b c a b c a b c a b c a b c a b c")],
        "doc_id long, text string",
    )
    docs = edge_docs.unionByName(more, allowMissingColumns=True)
    want = []
    for r in docs.collect():
        words = WORD.findall(r.text or "")
        runs = plain_runs(words) if len(words) < 5000 else []  # the long edge text is random
        want.append((r.doc_id, len(words), runs, collapsed(words, runs)))
    assert by_id(map(as_tuple, periodic_runs(docs, flush_words=flush).collect())) == by_id(want)
    assert periodic_runs(no_docs).count() == 0


def test_query(spark):
    want = []
    for doc_id, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append(
            (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
             sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(collapsed(words, runs)))
        )
    got = [tuple(r) for r in QUERIES["op12_recompression_runs"](spark, FOLDER).collect()]
    assert by_id(got) == by_id(want)
    assert sum(r[1] > 0 for r in want) > 10
