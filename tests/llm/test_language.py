import zlib

import numpy as np
import pytest

from lakeloom.llm import language
from lakeloom.llm.queries import op1


def phrases(text, sample):
    """Greedy parse of ``text`` into longest substrings of ``sample``."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        count += 1
        at = max(end - 1, at + 1)
    return count


def test_parse_is_the_greedy_longest_match_parse():
    samples = {"x": "abracadabra alakazam", "y": "zyxw abab caca"}
    parser = language.CrossParser(samples)
    texts = ["abrakadabra", "caca zyx q alak", "zzzz", "a", "abab" * 20, ""]
    counts, characters = parser.parse(texts)
    for t, row, n in zip(texts, counts, characters):
        assert n == len(t)
        if t:
            assert row.tolist() == [phrases(t, samples["x"]), phrases(t, samples["y"])]


def automaton(parser, name):
    return parser.automata[parser.languages.index(name)]


@pytest.mark.parametrize("dense", [2, 1000])
@pytest.mark.parametrize("piece", [1, 3, 256])
def test_phrases_go_over_the_borders_of_pieces(monkeypatch, piece, dense):
    monkeypatch.setattr(language, "PIECE", piece)
    monkeypatch.setattr(language, "DENSE_SYMBOLS", dense)
    rng = np.random.default_rng(piece)
    samples = {name: "".join(rng.choice(list(letters), 300)) for name, letters in (("x", "abc"), ("y", "abcd "), ("z", "pq"))}
    samples = {name: language.normalised(s) for name, s in samples.items()}
    parser = language.CrossParser(samples)
    assert (automaton(parser, "x").table is None) == (dense == 2)
    texts = [language.normalised("".join(rng.choice(list("aaabbcdpqr "), int(n)))) for n in rng.integers(1, 700, 40)]
    texts += [samples["x"][5:290], "ab" * 400, samples["y"] + samples["x"]]
    counts, _ = parser.parse(texts)
    for t, row in zip(texts, counts):
        assert row.tolist() == [phrases(t, samples[name]) for name in "xyz"]


def test_stretches_of_a_very_long_text_go_on(monkeypatch):
    monkeypatch.setattr(language, "BATCH_CHARS", 600)
    rng = np.random.default_rng(2)
    samples = {"x": "".join(rng.choice(list("abc"), 300)), "y": "".join(rng.choice(list("abd"), 300))}
    texts = ["".join(rng.choice(list("abcd"), n)) for n in (5000, 10, 1200, 601, 599)]
    counts, characters = language.CrossParser(samples).parse(texts)
    assert characters.tolist() == [len(t) for t in texts]
    assert counts.tolist() == [[phrases(t, samples["x"]), phrases(t, samples["y"])] for t in texts]


def test_many_characters_in_one_language_do_not_widen_the_others():
    rng = np.random.default_rng(1)
    wide = "".join(chr(0x4E00 + int(i)) for i in rng.integers(0, 1670, 5000))
    parser = language.CrossParser({"wide": wide, "x": "abcab"})
    assert automaton(parser, "x").width == 6  # three letters, space, unseen, fill
    assert automaton(parser, "wide").table is None
    counts, _ = parser.parse([wide[100:400], "abc" + wide[:3]])
    assert counts.tolist() == [[1, 300], [phrases("abc" + wide[:3], wide), 4]]


def test_automaton_reads_exactly_the_substrings():
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, 3, 60).tolist()
    moves = language.suffix_automaton(symbols)
    inside = {tuple(symbols[i:j]) for i in range(60) for j in range(i, min(60, i + 6) + 1)}
    for word in [tuple(rng.integers(0, 3, n)) for n in rng.integers(1, 6, 300)]:
        state = 0
        for c in word:
            state = moves[state].get(int(c), -1)
            if state < 0:
                break
        assert (state >= 0) == (word in inside)


@pytest.fixture(scope="module")
def predicted(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    return op1(spark, folder).join(docs, "doc_id").collect()


def test_held_out_accuracy(predicted):
    held = [r for r in predicted if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in predicted)
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in predicted)


def test_edge_rows(edge_docs, no_docs):
    rows = language.identify(edge_docs, edge_docs.where("doc_id IS NOT NULL")).collect()
    assert len(rows) == edge_docs.count()
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3)} == {("und", 0.0)}
    assert {r.lang_pred for r in rows} <= {"und", "en", "de", "fr"}
    assert language.identify(no_docs, no_docs).count() == 0
    nothing_learnt = language.identify(edge_docs, no_docs).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in nothing_learnt] == [("und", 0.0)]


def test_sample_is_bounded(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 50) AS text", "'en' AS lang")
    found = language.samples(rows, sample_chars=5000, document_chars=200)
    assert 4500 <= len(found["en"]) <= 5001 + 200


def test_the_languages_with_the_most_text_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = spark.range(60).selectExpr("id AS doc_id", "repeat('word ', int(id % 3 + 1)) AS text", "concat('l', id % 3) AS lang")
    assert set(language.samples(rows)) == {"l1", "l2"}
