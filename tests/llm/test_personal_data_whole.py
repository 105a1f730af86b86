"""Personal data that digits and shapes alone do not show."""

from lakeloom.llm import personal_data as pd_
from tests.llm.conftest import SCHEMA, prose

import random

RARE = [
    ("my number is 123-45-6789 since then", ["123-45-6789"]),
    ("call (843) 555-7672 or 843-555-7672 now", ["(843) 555-7672", "843-555-7672"]),
    ("the password: correcthorsebattery was shared", ["correcthorsebattery"]),
    ("then DB_PASSWORD=correcthorse is set", ["DB_PASSWORD=correcthorse"]),
    ("the token = \"f3ef4d6b2755a36d7d9c25bd\" is old", ['"f3ef4d6b2755a36d7d9c25bd"']),
    ("yesterday Jennifer Okafor came by", ["Jennifer Okafor"]),
    ("the secret is out and a password reset helps", []),
    ("on 2024-01-15 and in 1999-2004 it rained", []),
    ("the train from Paris to Berlin was late", []),
    ("Version 2.0, chapter 3, page 12", []),
    ("item 4929123456781234 of lot 00012345678901234567 was sold", []),
]


def test_rare_kinds_among_many_dates(spark):
    rng = random.Random(3)
    dates = [f"{prose(rng, 4)} {1950 + k % 70}-{k % 12 + 1:02}-{k % 28 + 1:02} {prose(rng, 3)} 1999-{2000 + k % 20}" for k in range(400)]
    rows = [(k, t, "en", "a", 1) for k, t in enumerate(dates)]
    rows += [(1000 + 100 * k + i, t, "en", "a", 1) for k in range(3) for i, (t, _) in enumerate(RARE)]
    got = pd_.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        added = [texts[r.doc_id][int(a) : int(b)] for kind, a, b in spans if kind == pd_.ADDED_KIND]
        assert r[f"n_{pd_.ADDED_KIND}"] == len(added)
        assert added == (RARE[r.doc_id % 100][1] if r.doc_id >= 1000 else []), texts[r.doc_id]


def test_hard_texts_take_linear_time():
    for text in ("password " * 30_000, "password:" * 30_000, "Anna " * 60_000, "A" * 300_000, "=" * 300_000, "1-" * 150_000):
        pd_._candidates(text, [])
