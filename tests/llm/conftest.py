import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = (
    "size block found length sig before label place body lead print spread mark rank n shared "
    "row own_id own_mark c_id c_mark __mark __id __of __position cut_to id of at start position piece"
).split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(words))


def edge_rows() -> list[tuple]:
    """NULLs, empty and very long texts, ties, copies, near copies and repeated rows."""
    rng = random.Random(5)
    base = prose(rng, 120).split(" ")
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b ", "en", "a", 5),
        (4, "One two", "en", "b", 7),
        (5, "one\ttwo", "fr", "b", 7),
        (6, "ONE TWO", "fr", None, 7),
        (7, "One two", "en", "b", 7),
        (7, "One two", "en", "b", 7),
        (8, "a b c d e a b c d e a b c d e", "en", "c", 29),
        (9, "é\U0001f600 ß　x " * 40, "de", "c", 240),
        (None, "no identifier here at all", "en", "c", 25),
        (10, prose(rng, 60_000), "en", "a", None),
        (11, "x" * 200_000, "en", "a", 200_000),
    ]
    for k in range(30):
        near = list(base)
        for _ in range(k % 4):
            near[rng.randrange(len(near))] = f"edit{rng.randrange(999)}"
        rows.append((100 + k, " ".join(near), "en", "hot", 600))
    rows += [(200 + k, " ".join(base), "en", "hot", 600) for k in range(12)]
    rows += [(300 + k, prose(rng, 40 + 5 * k), "en" if k % 2 else "de", f"s{k % 3}", 200) for k in range(20)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The rows above over many partitions, with further columns whose names clash."""
    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(5)
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df.cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(type(x)), x) if x is not None else (False, "", 0) for x in r))
