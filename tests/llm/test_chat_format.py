import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.llm import chat_format as chat
from tabkit.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_score(model, symbols, path):
    score, before = 0, chat.START
    for s, state in zip(symbols, path, strict=True):
        score += int(model.move[before, state]) + int(model.emit[state, s])
        before = state
    return score


def plain_best(model, symbols):
    best = {chat.START: 0}
    for s in symbols:
        best = {j: max(v + int(model.move[i, j]) for i, v in best.items()) + int(model.emit[j, s]) for j in range(chat.STATES)}
    return max(best.values())


def test_viterbi_over_blocks_is_exact(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 4)
    rng = np.random.default_rng(2)
    model = chat.ChatModel(rng.integers(0, 5, (chat.STATES + 1, chat.STATES)), [rng.integers(0, 9, (chat.STATES, s)) for s in chat.FEATURES])
    sizes = {"a": 1, "b": 4, "c": 5, "d": 100, "e": 17, "f": 64}
    symbols = {k: rng.integers(0, chat.SYMBOLS, n).tolist() for k, n in sizes.items()}
    rows = [(k, p, s) for k, v in symbols.items() for p, s in enumerate(v)]
    lines = spark.createDataFrame(rows, "key string, pos long, symbol int")
    found = {}
    for r in chat.viterbi_states(lines, model).collect():
        found.setdefault(r.key, {})[r.pos] = r.state
    for k, v in symbols.items():
        path = [found[k][p] for p in range(len(v))]
        assert len(found[k]) == len(v) and plain_score(model, v, path) == plain_best(model, v)


@pytest.mark.parametrize(
    "line, name",
    [("User: hi", "user"), ("[assistant] yes", "assistant"), ("### Response: ok", "response"), ("**AI:** no", "ai"), ("Human> why", "human"),
     ("the user: said", None), ("useful: no", None), ("", None)],
)
def test_markers(spark, line, name):
    assert chat.marker_of(line) == name
    df = spark.createDataFrame([(1, 0, line or " ")], "conv_id long, turn long, text string")
    got = chat.transcript_lines(df, "conv_id", "turn", "text").first()
    role = next((r for r, names in chat.SPEAKERS.items() if name in names), None)
    assert (got.marker if got else None) == role


def test_roles_and_turns_come_back(spark):
    want = spark.read.parquet(f"{SMALL}/conversations.parquet")
    got = QUERIES["op2_chat_hmm"](spark, SMALL)
    assert got.count() == want.count()
    both = got.join(want.select("conv_id", "turn", F.col("role").alias("r"), "text"), ["conv_id", "turn"]).collect()
    assert len(both) == want.count()
    assert np.mean([b.role == b.r and b.content == b.text for b in both]) > 0.98
    assert all(b.rendered == f"<|{b.role}|>\n{b.content}\n<|end|>" for b in both)


def test_hard_rows(spark, hard, nothing):
    rows = [
        (1, 0, "User: hello\r\nsecond line", "u"), (1, 1, None, "a"), (1, 2, "Assistant:", "a"), (1, 2, "", "a"), (1, None, "System: be kind", "s"),
        (None, 0, "Human: one", "u"), (None, 0, "Human: one", "u"), (2, 5, " \n ", None), (3, 0, "no marker at all?", None), (1, 3, "Q: x", "u"),
    ]
    df = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], "conv_id long, turn long, text string, role string, pos int, key string, source int")
    got = {}
    for r in chat.canonical_turns(df).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.content, r.source_turn))
    assert got[1][0] == ("system", "be kind", None)
    assert got[1][1] == ("user", "hello\nsecond line", 0)
    assert got[1][2][0] == "assistant" and got[1][2][1].startswith("")
    assert got[None] == [("user", "one", 0)] * 2
    assert set(got) == {1, 3, None} and len(got[3]) == 1
    assert chat.canonical_turns(df.where("false")).count() == 0
    assert isinstance(chat.fit_chat_model(chat.transcript_lines(df, "conv_id", "turn", "text", "role")), chat.ChatModel)


def contents(df, model=None):
    return [(r.role, r.content) for r in chat.canonical_turns(df, model).orderBy("conv_id", "turn").collect()]


def test_blank_lines_stay(spark):
    code = "Try this:\n\n```\ndef f():\n\n\n    return 1\n```\n\nDone.\n"
    rows = [(0, "User: first\n\n- one\n- two"), (1, f"[assistant] {code}"), (2, "\nsecond paragraph\n \nlast?"), (3, "Assistant: a\n\n\nUser: b")]
    df = spark.createDataFrame([(1, *r) for r in rows], "conv_id long, turn long, text string")
    assert contents(df) == [
        ("user", "first\n\n- one\n- two"), ("assistant", code), ("user", "second paragraph\n \nlast?"), ("assistant", "a\n"), ("user", "b"),
    ]


def test_blank_message_of_the_blank_line_style_is_a_turn(spark):
    rows = [(1, 0, "User: hi"), (1, 1, "\n"), (1, 2, "User: still there?")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    assert contents(df) == [("user", "hi"), ("assistant", ""), ("user", "still there?")]


def test_inner_markers_stay(spark):
    said = ("[user] Solve it", "[assistant] Let me see.\nContext: a sum\nAnswer: 42") * 2
    told = [(i, t, ("user", "assistant")[t % 2], text) for i in range(40) for t, text in enumerate(said)]
    df = spark.createDataFrame(told, "conv_id long, turn long, role string, text string")
    model = chat.fit_chat_model(chat.transcript_lines(df, "conv_id", "turn", "text", "role"))
    assert contents(df.where("conv_id = 0"), model) == [("user", "Solve it"), ("assistant", "Let me see.\nContext: a sum\nAnswer: 42")] * 2
