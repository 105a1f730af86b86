import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakeloom.llm import packing


def best_fit_decreasing(histogram, capacity):
    slack, bins = [], 0
    for item in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        i = bisect.bisect_left(slack, item)
        if i < len(slack):
            left = slack.pop(i) - item
        else:
            bins, left = bins + 1, capacity - item
        bisect.insort(slack, left)
    return bins


@pytest.mark.parametrize(
    "histogram",
    [
        {},
        {2048: 3},
        {1: 5},
        {1025: 10, 1023: 10},
        {700: 100},
        {683: 60, 682: 60, 683 * 2: 5},
        Counter(np.random.default_rng(2).integers(1, 2048, 3000).tolist()),
        Counter(np.random.default_rng(3).lognormal(6, 1, 5000).astype(int).clip(1, 2048).tolist()),
    ],
)
def test_configurations_hold_every_piece(histogram):
    configs = packing.configurations(histogram, 2048)
    held = Counter()
    for times, taken in configs:
        assert times > 0 and sum(n * k for n, k in taken.items()) <= 2048
        for n, k in taken.items():
            held[n] += times * k
    assert held == Counter(histogram)
    used = sum(t for t, _ in configs)
    assert used <= best_fit_decreasing(histogram, 2048) * 1.005 + 2


def solved(histogram, capacity=2048):
    lengths = np.array(sorted(histogram))
    return packing.fractional_program(lengths, np.array([histogram[n] for n in lengths]), capacity)


HALVES = {1044: 6000, 532: 6000, 552: 6000, 472: 12000}
MIDDLING = Counter(np.random.default_rng(4).integers(300, 1100, 60_000).tolist())


@pytest.mark.parametrize("histogram", [{5: 3}, {683: 60, 682: 60}, HALVES, MIDDLING])
def test_bound_of_the_program(histogram):
    amounts, prices, bound = solved(histogram)
    used = sum(t for t, _ in packing.configurations(histogram, 2048))
    assert -(-sum(n * c for n, c in histogram.items()) // 2048) - 1e-6 <= np.ceil(bound - 1e-6) <= used
    assert used <= bound + len(amounts)
    # The prices are a solution of the dual program: no filling of a sequence is worth more than one.
    best, _ = packing.knapsack(np.array(sorted(histogram)), prices, 2048)
    assert best[2048] <= 1 + 1e-9


def test_amounts_of_the_program_are_used():
    assert sum(t for t, _ in packing.configurations(HALVES, 2048)) == 9000
    assert best_fit_decreasing(HALVES, 2048) > 10_900
    lengths = np.array(sorted(MIDDLING))
    counts = np.array([MIDDLING[n] for n in lengths])
    by_length = packing._packed_remainder(lengths, counts, lengths / 2048, 2048)
    used = sum(t for t, _ in packing.configurations(MIDDLING, 2048))
    assert used < 0.99 * sum(t for t, _ in by_length)
    assert used < 0.99 * best_fit_decreasing(MIDDLING, 2048)


def test_dynamic_program_against_enumeration():
    lengths, prices = np.array([3, 4, 7]), np.array([2.0, 3.0, 5.5])
    best, _ = packing.knapsack(lengths, prices, 25)
    for room in range(26):
        want = max(a * 2 + b * 3 + c * 5.5 for a in range(9) for b in range(7) for c in range(4) if 3 * a + 4 * b + 7 * c <= room)
        assert best[room] == pytest.approx(want)


def check(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    whole = Counter()
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4").tobytes()
            whole[(piece, start, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == whole
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_edge_rows(edge_docs, no_docs):
    rows = packing.pack(edge_docs, 512).collect()
    used = check(rows, [r.text for r in edge_docs.collect()], 512)
    assert used <= best_fit_decreasing(Counter(r.length for r in rows), 512) * 1.01 + 2
    assert packing.pack(no_docs).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs).collect()
    used = check(rows, [r.text for r in docs.collect()], 2048)
    assert used <= best_fit_decreasing(Counter(r.length for r in rows), 2048) + 1


def test_words_are_encoded_as_in_their_text(monkeypatch):
    texts = ["", "  ", "İstanbul. \xc9., A'S it's. x.,y ... ,. 12. a1., H̱., don't., <|endoftext|>. \x1c a\x1cb  c.", None, "H̱İ ḱ."]
    monkeypatch.setattr(packing, "REMEMBER_WORDS", 3)
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.encoded(texts * 3, packing.default_tokenizer())]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts * 3]
