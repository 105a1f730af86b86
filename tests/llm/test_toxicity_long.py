"""Labelled documents of every length are learnt from."""

from lakeloom.llm import toxicity
from tests.llm.conftest import SCHEMA


def test_long_labelled_documents(spark):
    filler = "some ordinary words that stand here and mean nothing much at all "
    # The passage lies in every chain, whichever of them the hash takes.
    bad = [(k, ("you IDIOT scum, " + filler * 3) * 60, "en", "a", 1) for k in range(30)]
    good = [(100 + k, filler * 60 + f"you kind friend number {k} " + filler * 60, "en", "a", 1) for k in range(30)]
    docs = spark.createDataFrame(bad + good, SCHEMA).repartition(3)
    assert all(len(r[1]) > 6000 for r in bad)
    labels = spark.createDataFrame([(r[0], 0, int(r[0] < 100)) for r in bad + good], "doc_id long, quality int, toxic int")
    rows = toxicity.score_toxicity(docs, docs, labels).collect()
    assert {r.doc_id for r in rows if r.score >= 0.5} == {r[0] for r in bad}
    assert toxicity.without_toxic(docs, docs, labels).count() == len(good)


def test_sample_of_a_text_is_whole_chains():
    words = [f"w{k}" for k in range(toxicity.CHAIN * 40 + 5)]
    got = toxicity.sampled_words(" ".join(words), 7)
    assert 0 < len(got) <= toxicity.CHAIN * toxicity.SAMPLE_CHAINS
    assert got == sorted(got, key=lambda w: int(w[1:])) and set(got) <= set(words)
    assert toxicity.sampled_words("One two", 7) == ["one", "two"]
