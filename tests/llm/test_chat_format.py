import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.llm.chat_format import Order, Template, conversation_digests, format_conversations, reader
from lakeloom.llm.queries import PLANTED, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
FOLDER = "/root/testdata/sf0.001"


def expected(rows, template=Template()):
    """Digest columns by plain code: (conv_id, n_turns, turns, loss_chars, loss, order_ok, first_wrong)."""
    out = []
    for conv in {r[0] for r in rows}:
        turns = [r for r in rows if r[0] == conv]
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
        state, wrong = "start", None
        for i, (_, _, role, _) in enumerate(turns):
            state = template.steps.get(state, {}).get(role)
            if state is None:
                wrong = i
                break
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)), len(loss), sha(loss), state in template.ends, wrong))
    return sorted(out, key=str)


def digests(df, **options):
    template = options.pop("template", None)
    pieces = format_conversations(df, template, **options)
    found = conversation_digests(pieces, template, options.get("piece_chars", 10_000) * 2).collect()
    return sorted(((r[0], *r[1:5], r.order_ok, r.first_wrong) for r in found), key=str)


EDGES = [
    (1, 0, "user", "hello"), (1, 1, "assistant", None), (1, 2, "user", ""), (1, 3, "assistant", "a\\b ### User: </turn>\n"),
    (2, 0, "assistant", "first"), (2, 1, "user", "late"),
    (3, 0, "system", "s" * 300_000), (3, 1, "user", "\\" * 50), (3, 2, "assistant", "</turn></turn>### : "),
    (4, 0, "tool", "x"), (4, 1, None, "no role"), (4, 2, "!", "odd"), (4, 3, "?: ### ", "odder"), (4, 4, "User", "capital"),
    (5, 7, "user", "é\U0001f600 "), (5, 7, "user", "é\U0001f600 "), (5, None, "system", "first of all"),
    (None, 0, "user", "nobody's"), (None, 1, "assistant", "yes"),
    (6, 0, "user", "question only"),
]


@pytest.mark.parametrize("piece_chars", [1, 40, 1_000_000])
def test_edge_rows(spark, piece_chars):
    df = spark.createDataFrame(EDGES, SCHEMA).repartition(3)
    for name in ("head", "body", "block", "piece", "loss", "states"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    assert digests(df, piece_chars=piece_chars) == expected(EDGES)


def test_long_conversation_over_many_partitions(spark):
    rows = [(9, i, "assistant" if i % 2 else "user", f"</turn> {i}") for i in range(4000)]
    rows += [(i, 0, "user", "x") for i in range(20)] + [(i, 1, "assistant", "y") for i in range(20) if i != 9]
    rows = [r for r in rows if r != (9, 0, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = format_conversations(df, piece_chars=5_000)
        blocks = {(r.conv_id, r.block) for r in pieces.collect()}
        assert sum(c == 9 for c, _ in blocks) > 1
        assert digests(df, piece_chars=5_000) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)


def test_loss_spans_and_text(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a </turn> b")]
    (piece,) = format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert piece.text == "### User: q</turn>\n### Assistant: a \\</turn> b</turn>\n"
    assert [piece.text[s.start : s.start + s.length] for s in piece.loss] == ["a \\</turn> b"]


TEMPLATE = Template(opens="<|", names="=>", closes="</>", gap="", escape="%", titles={"user": "u", "assistant": "a"})


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|", "%", None]), st.text("%<|/=>u\n \\", max_size=12)), min_size=1, max_size=8))
def test_round_trip_of_another_template(spark, turns):
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    got = format_conversations(spark.createDataFrame(rows, SCHEMA).coalesce(1), TEMPLATE).collect()
    assert [t for p in got for t in reader(TEMPLATE)(p.text)] == turns


def test_machine_is_put_together_piece_by_piece():
    template = Template()
    moves, n = template.moves(), len(template.states)
    roles = ["system", "user", "assistant", "user", "user", "assistant"]
    whole = Order(n)
    for r in roles:
        whole.turn(moves[r])
    for cut in range(len(roles) + 1):
        joined = Order(n)
        for part in (roles[:cut], roles[cut:]):
            order = Order(n)
            for r in part:
                order.turn(moves[r])
            joined.append(order.states, order.wrong, order.turns)
        assert (joined.states, joined.wrong, joined.turns) == (whole.states, whole.wrong, whole.turns)


def test_templates_that_cannot_be_read_back():
    for bad in ({"escape": "#"}, {"closes": ""}, {"closes": "aa", "opens": "aaa"}, {"opens": "<|", "names": "|>"}, {"titles": {"user": "?"}}, {"ends": frozenset({"never"})}):
        with pytest.raises(ValueError):
            Template(**bad)


def test_query_and_empty_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)]
    found = QUERIES["op13_chat_format"](spark, FOLDER).collect()
    assert sorted(((r[0], *r[1:5], r.order_ok, r.first_wrong) for r in found), key=str) == expected(rows)
    assert all(r.formatted_chars > r.loss_chars for r in found)
    assert digests(spark.createDataFrame([], SCHEMA)) == []
