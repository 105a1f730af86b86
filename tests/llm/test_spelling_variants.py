import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm.queries import QUERIES
from lakeloom.llm.spelling_variants import Acceptor, belongs, near_pairs, spelling_variants, vocabulary
from tests.llm.conftest import by_id

FOLDER = "/root/testdata/sf0.001"


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_pairs(words):
    """Near pairs: by equal words after one code point is left out or masked."""
    masks = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i] + "*" + w[i + 1 :]].add(w)
            masks[w[:i] + w[i + 1 :]] |= {(w,)}
    pairs = set()
    for key, found in masks.items():
        same = sorted(x for x in found if isinstance(x, str))
        if "*" in key:
            pairs |= set(combinations(same, 2))
        if key in words:
            pairs |= {tuple(sorted((key, x[0]))) for x in found if isinstance(x, tuple)}
    return pairs


def plain_variants(counts):
    near = defaultdict(set)
    for a, b in plain_pairs(counts):
        near[a].add(b)
        near[b].add(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return by_id(out)


words = st.lists(st.text("abc", min_size=1, max_size=7), min_size=1, max_size=40, unique=True)


@settings(max_examples=200, deadline=None)
@given(words)
def test_acceptor_and_composition(some):
    some = sorted(some)
    acceptor = Acceptor(some)
    assert sorted(acceptor.language()) == some
    rights = [frozenset(Acceptor_words(acceptor, q)) for q in range(len(acceptor.arcs))]
    assert len(set(rights)) == len(rights)  # no two states accept the same
    got = []
    for size in range(1, 8):
        short = Acceptor([w for w in some if len(w) == size])
        long = Acceptor([w for w in some if len(w) == size + 1])
        got += [*near_pairs(short)] + [*near_pairs(short, long)]
    assert len(got) == len(set(got))
    assert {tuple(sorted(p)) for p in got} == plain_pairs(set(some))


def Acceptor_words(acceptor, state):
    out = [""] if state in acceptor.final else []
    return out + [c + w for c, to in acceptor.arcs[state].items() for w in Acceptor_words(acceptor, to)]


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=4, max_size=9), st.integers(0, 9), st.sampled_from("ab*"))
def test_a_pair_has_one_path(word, at, edit):
    at = min(at, len(word) - 1)
    other = word[:at] + (word[at + 1 :] if edit == "*" else edit + word[at + 1 :])
    if other == word:
        return
    length = min(len(word), len(other))
    for depth in (1, 2):
        paths = ["L", "R"] if depth == 1 else ["LL", "LR", "RL", "RR"]
        fits = []
        for path in paths:
            a, b, m = word, other, length
            shared = True
            for side in path:
                k = m // 2
                if side == "L":
                    shared &= a[:k] == b[:k]
                    a, b, m = a[k:], b[k:], m - k
                else:
                    cut = m - k
                    shared &= a[len(a) - cut :] == b[len(b) - cut :]
                    a, b, m = a[: len(a) - cut], b[: len(b) - cut], k
            if shared and belongs(word, other, length, path):
                fits.append(path)
        assert len(fits) == 1


@pytest.mark.parametrize("state_words", [3, 20_000])
def test_words_by_brute_force(spark, state_words):
    import random

    rng = random.Random(7)
    counts = {}
    for _ in range(700):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(5, 9)))
        counts[w] = rng.choice([3, 3, 4, 6, 12, 30, 70])
    long = "z" * 3000
    counts |= {long: 9, long + "z": 3, long[:1500] + "y" + long[1501:]: 40, "lonely": 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    got = [tuple(r) for r in spelling_variants(df, state_words=state_words).collect()]
    assert by_id(got) == plain_variants(counts)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for held in (1, 200_000):
        got = {r.word: r.n for r in vocabulary(edge_docs, held_words=held).collect()}
        assert got == plain_counts(rows)
    assert spelling_variants(vocabulary(no_docs)).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_variants(plain_counts(rows))
    got = [tuple(r) for r in QUERIES["op11_spelling_variants"](spark, FOLDER).collect()]
    assert by_id(got) == want
    assert sum(r[1] is not None for r in want) > 10
