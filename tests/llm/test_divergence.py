import numpy as np

from lakeloom.llm import divergence
from pyspark.sql import functions as F
from tests.llm import brute_force
from tests.llm.conftest import by_id

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts(spark, edge_docs, no_docs):
    rows = divergence.judge(edge_docs).select("doc_id", *BASE).collect()
    want = by_id((r.doc_id, *brute_force.base_counts(r.text)) for r in edge_docs.collect())
    assert by_id(tuple(r) for r in rows) == want
    assert divergence.judge(no_docs).count() == 0


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = divergence.judge(docs).join(docs.select("doc_id", "text"), "doc_id").join(labels, "doc_id", "left").collect()
    for r in rows:
        assert tuple(r[c] for c in BASE) == brute_force.base_counts(r.text)
        assert not (r.base_failed and r.kept)
    judged = [r for r in rows if not r.base_failed]
    assert np.mean([r.kept for r in judged if r.quality == 1]) >= 0.99
    assert np.mean([not r.kept for r in judged if r.quality == 0]) >= 0.5


def test_distance(spark):
    cases = [([1, 0], [1, 0], 0.0), ([1, 0], [0, 1], 1.0), ([3, 1], [1, 1], None), ([0, 0], [1, 1], None)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "p array<long>, q array<long>")
    got = [r[0] for r in df.select(divergence._distance(F.col("p"), F.col("q"))).collect()]
    for value, (p, q, want) in zip(got, cases):
        if want is None:
            p, q = (np.array(x) / max(sum(x), 1) for x in (p, q))
            m = (p + q) / 2
            part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a)
            want = np.sqrt((part(p) + part(q)) / 2)
        assert np.isclose(value, want)


def test_short_texts_are_guarded(spark):
    docs = spark.createDataFrame([(i, "ordinary little words in a text " * 20, "en") for i in range(50)] + [(99, "## $$ %%", "en")], "doc_id long, text string, lang string")
    row = divergence.judge(docs).where("doc_id = 99").first()
    assert row.character_distance is None and row.word_distance is None and row.base_failed


def test_no_python_runs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = divergence.features(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_common_words_have_any_length(spark):
    long = "gewissermassen niemals vollkommen"
    docs = spark.createDataFrame([(i, f"{long} " * 30 + f"eigenwort{'abcdefghij'[i % 10]}", "de") for i in range(30)] + [(99, "anders " * 91, "de")], "doc_id long, text string, lang string")
    rows = divergence.features(docs)
    (known,) = divergence.references(rows, divergence.common_words(rows)).collect()
    assert known.ref_common[:4] == ["gewissermassen", "niemals", "vollkommen", "anders"]
    assert list(known.ref_counts[:4]) == [900, 900, 900, 91] and known.ref_counts[-1] == 0
    rows = {r.doc_id: r.word_distance for r in divergence.judge(docs).collect()}
    assert rows[0] < 0.2 and rows[99] > 0.8
