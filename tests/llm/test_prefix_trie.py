import hashlib
import random
import zlib

import pytest

from tabkit.llm import prefix_trie


def plain(conversations):
    """All nodes of {conv_id: [(role, text), ...]} by definition."""
    prefixes = {(): sorted(conversations)}
    for c in sorted(conversations):
        for d in range(1, len(conversations[c]) + 1):
            prefixes.setdefault(tuple(conversations[c][:d]), []).append(c)
    if not conversations:
        return []
    kids = {p: [q for q in prefixes if len(q) == len(p) + 1 and q[: len(p)] == p] for p in prefixes}
    rows = []
    for p, members in prefixes.items():
        below = [q for q in prefixes if q[: len(p)] == p]
        ends = ",".join(str(c) for c in members if len(conversations[c]) == len(p))
        rows.append(
            (
                members[0], len(p), prefixes[p[:-1]][0] if p else None, len(members), len(kids[p]), sum(not kids[q] for q in below),
                sum((len(prefixes[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


def of(spark, conversations, shuffle=7):
    rows = [(c, t, role, text) for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    random.Random(shuffle).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")


def digests(df):
    return sorted(map(tuple, prefix_trie.trie_digests(prefix_trie.conversation_trie(df)).collect()), key=str)


def some(n, longest, seed):
    rng = random.Random(seed)
    made = {}
    for c in rng.sample(range(-50, 50_000), n):
        turns = list(made[rng.choice(list(made))][: rng.randrange(longest)]) if made and rng.random() < 0.7 else []
        turns += [(rng.choice(["user", "bot"]), rng.choice(["a", "é", "", "long text"])) for _ in range(rng.randrange(1, longest))]
        made[c] = turns[:longest]
    return made


@pytest.mark.parametrize("longest", [3, 40])
def test_trie_equals_plain_version(spark, longest, monkeypatch):
    conversations = some(60, longest, longest)
    want = plain(conversations)
    assert digests(of(spark, conversations)) == want
    # several slices, ranges, crowded parents and id chunks
    monkeypatch.setattr(prefix_trie, "SLICE", 2)
    monkeypatch.setattr(prefix_trie, "CROWD", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 4)
    monkeypatch.setattr("tabkit.llm.common.RANGE_ROWS", 100)
    assert digests(of(spark, conversations)) == want


def test_rollup_covers_a_block(spark):
    turns = prefix_trie.numbered_turns(of(spark, {1: [("u", "x")] * 20}))
    plan = prefix_trie._rolled(prefix_trie._blocks(turns), "count(*) AS n")._jdf.queryExecution().toString()
    assert "Expand" in plan and plan.count("grouping_id") >= 1


def test_hard_rows(spark):
    rows = [
        (1, None, "user", "b", 1), (1, 0, None, "a", 2), (1, 1, "user", None, 3), (1, 1, "user", None, 4), (2, 0, "user", "b", 5),
        (None, 0, "user", "lost", 6), (3, 5, "", "", 7), (4, 9, None, None, 8),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, depth int")
    df = df.selectExpr("*", "depth AS place", "text AS block", "depth AS node_a", "depth AS k0")
    want = {1: [("user", "b"), ("", "a"), ("user", ""), ("user", "")], 2: [("user", "b")], 3: [("", "")], 4: [("", "")]}
    assert digests(df) == plain(want)
    assert digests(df.where("false")) == []
    turnless = prefix_trie.prefix_trie(prefix_trie.numbered_turns(df.where("false")), df.select("conv_id"))
    assert sorted(map(tuple, prefix_trie.trie_digests(turnless).collect()), key=str) == plain({1: [], 2: [], 3: [], 4: []})


def test_grafted_conversations(spark):
    own = {c: [("user", f"{c}-{i}") for i in range(n)] for c, n in [(0, 4), (1, 1), (7, 9), (99, 3), (100, 2), (130, 8), (205, 3), (206, 6), (-30, 5)]}
    want = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = own.get(c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), [])
        want[c] = first[:h] + turns[h:]
    turns, every = prefix_trie.grafted(prefix_trie.numbered_turns(of(spark, own)))
    got = sorted(map(tuple, prefix_trie.trie_digests(prefix_trie.prefix_trie(turns, every)).collect()), key=str)
    assert got == plain(want)


def test_many_equal_conversations(spark):
    df = spark.range(6000).selectExpr("id AS conv_id", "0 AS turn", "'user' AS role", "if(id % 3 = 0, 'hot', concat('t', id)) AS text")
    got = {r["depth"]: r for r in prefix_trie.trie_digests(prefix_trie.conversation_trie(df)).where("conv_id = 0").collect()}
    ids = ",".join(str(c) for c in range(0, 6000, 3))
    assert got[1]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest() and got[1]["n_convs"] == 2000
    assert got[0]["n_children"] == 4001 and got[0]["saved_tokens"] == 1999 * 3
