import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabkit.llm import lm_scoring as lm
from tabkit.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    raw = (text or "").encode()
    return [*bytes(b + 32 if 65 <= b <= 90 else b for b in raw).split(), b"<end>"]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def base_scores(rows):
    counts = Counter(t for d, text in rows if not held(d) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for d, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        out.append((d, held(d), len(own), sum(t in counts for t in own), total, pytest.approx(base)))
    return out


def test_base_scores_and_gain(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARED_WORDS", 700)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = sorted(QUERIES["op1_gated_lm"](spark, SMALL).collect(), key=lambda r: r.doc_id)
    assert [tuple(r)[:6] for r in rows] == base_scores(sorted((tuple(r) for r in docs.collect())))
    assert all(r.score < 0 for r in rows)
    gain = [r.score - r.base_score for r in rows if r.held_out]
    assert sum(gain) > 0


def test_hard_rows(spark, hard, nothing):
    from tests.llm.conftest import HARD

    rows = lm.score_documents(hard).collect()
    key = lambda r: (str(r[0]), r[2])
    assert sorted((tuple(r)[:6] for r in rows), key=key) == sorted(base_scores([h[:2] for h in HARD]), key=key)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert len({round(r.score, 4) for r in rows if r.doc_id in (1, 5)}) == 1
    assert lm.score_documents(nothing).count() == 0
    unlearned = lm.score_documents(hard.selectExpr("9L AS doc_id", "text").where("text = ''")).collect()
    assert [(r.held_out, r.n_known, r.train_tokens, r.base_score) for r in unlearned] == [(held(9), int(not held(9)), 0 if held(9) else 1, unlearned[0].base_score)]
    only_held = next(i for i in range(100) if held(i))
    row = lm.score_documents(hard.selectExpr(f"{only_held}L AS doc_id", "text").where("doc_id IS NOT NULL")).first()
    assert (row.held_out, row.n_known, row.train_tokens, row.base_score) == (True, 0, 0, 0.0) and row.score <= 0


def tiny(monkeypatch, texts, shared=1000):
    for name, value in (("HEAD_WORDS", 10), ("CLASS_WORDS", 4), ("ENDINGS", 3)):
        monkeypatch.setattr(lm, name, value)
    coded, _ = lm.split_words(pa.array(texts))
    n = np.bincount(np.asarray(coded.indices))
    counts = dict(zip(coded.dictionary.to_pylist(), n.tolist(), strict=True)) | {lm.END: len(texts)}
    rows = sorted(counts.items(), key=lambda r: (-r[1], r[0]))
    ends = sorted({w[-3:] for w, _ in rows[10:]})[:3]
    total, distinct = np.zeros(4), np.zeros(4)
    for w, k in rows[10:]:
        c = ends.index(w[-3:]) if w[-3:] in ends else 3
        total[c] += k
        distinct[c] += 1
    kept = rows[:shared]
    return lm.Vocabulary([w for w, _ in kept], np.array([k for _, k in kept]), ends, int(n.sum()) + len(texts), len(rows), total, distinct), counts


TEXTS = ["the cat saw the dog and the dog saw a bird", "a bird ate the worm", "dogs and cats like the sun and the moon", "stars shine at night for the cat"]


def test_words_of_the_vocabulary_and_unseen_ones_sum_to_one(monkeypatch):
    v, counts = tiny(monkeypatch, TEXTS)
    model = lm.GatedModel(v)
    trainer = lm.Trainer(model, v)
    for _ in range(5):
        codes, lengths = lm.code_texts(pa.array(TEXTS), v)
        trainer.learn(codes.astype(np.int64), lengths)
    state = np.random.default_rng(0).uniform(-1, 1, (1, lm.HIDDEN)).astype(np.float32)
    total = 0.0
    for w in counts:
        i = int(v.codes([w])[1][0])
        p = math.exp(model.log_probability(state, np.array([i]))[0])
        if i >= v.head:
            p *= (counts[w] + 1) / (v.tail_total[i - v.head] + v.tail_distinct[i - v.head] + 1)
        total += p
    for c in range(len(v.endings) + 1):
        p = math.exp(model.log_probability(state, np.array([v.head + c]))[0])
        total += p / (v.tail_total[c] + v.tail_distinct[c] + 1)
    assert total == pytest.approx(1.0, abs=1e-4)


def test_gradients_against_differences(monkeypatch):
    v, _ = tiny(monkeypatch, TEXTS)
    model = lm.GatedModel(v)
    for n in lm.GatedModel.NAMES:
        setattr(model, n, getattr(model, n).astype(np.float64))
    rng = np.random.default_rng(1)
    h0 = rng.uniform(-0.5, 0.5, (3, lm.HIDDEN))
    inputs, target = rng.integers(0, v.inputs, (6, 3)), rng.integers(0, v.inputs, (6, 3))
    fresh, weight = np.ones((6, 3)), np.ones((6, 3))
    fresh[2, 1], weight[5, 2] = 0, 0

    def loss():
        h, total = h0, 0.0
        for t in range(6):
            h = model.step(h * fresh[t][:, None], inputs[t])[0]
            total -= (model.log_probability(h, target[t]) * weight[t]).sum()
        return total / weight.sum()

    grads, _ = model.gradients(h0, inputs, fresh, target, weight)
    for p, g in zip(model.parameters(), grads, strict=True):
        flat, got = p.reshape(-1), g.reshape(-1)
        for i in rng.choice(len(flat), min(12, len(flat)), replace=False):
            if flat[i] < -1e6:
                continue
            keep = flat[i]
            flat[i] = keep + 1e-5
            up = loss()
            flat[i] = keep - 1e-5
            down = loss()
            flat[i] = keep
            assert got[i] == pytest.approx((up - down) / 2e-5, abs=2e-4)


def test_state_is_carried_across_windows(monkeypatch):
    v, counts = tiny(monkeypatch, TEXTS, shared=12)
    model = lm.GatedModel(v)
    trainer = lm.Trainer(model, v)
    for _ in range(3):
        codes, lengths = lm.code_texts(pa.array(TEXTS), v)
        trainer.learn(codes.astype(np.int64), lengths)
    texts = pa.array([" ".join(TEXTS) * 3, None, "Zebra the CAT", TEXTS[1]])
    found = []
    for steps in (1, 4, 100):
        monkeypatch.setattr(lm, "SCORE_STEPS", steps)
        found.append(np.asarray(lm.score_chunk(model, v, texts)["partial"]))
    assert found[0] == pytest.approx(found[1], rel=1e-5) and found[0] == pytest.approx(found[2], rel=1e-5)
    one = lm.score_chunk(model, v, texts)
    for i, text in enumerate(texts.to_pylist()):
        h, before, score = np.zeros((1, lm.HIDDEN), np.float32), int(v.codes([lm.END])[1][0]), 0.0
        for w in [t.decode() for t in tokens(text)[:-1]] + [lm.END]:
            h = model.step(h, np.array([before]))[0]
            rank, code = (int(a[0]) for a in v.codes([w]))
            score += model.log_probability(h, np.array([code]))[0] / math.log(10)
            if code >= v.head:
                c = code - v.head
                score += math.log10(((v.counts[rank] if rank >= 0 else 0) + 1) / (v.tail_total[c] + v.tail_distinct[c] + 1))
            before = code
        assert one["partial"][i].as_py() == pytest.approx(score, rel=1e-4)


def test_end_and_equal_counts_with_few_shared_words(spark, monkeypatch):
    """Long texts: the end is rarer than most words, and the last grade of equal counts does not fit as a whole."""
    monkeypatch.setattr(lm, "SHARED_WORDS", 600)
    rows = [(i, " ".join(f"w{(i * 37 + j) % 900}" for j in range(3000))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = lm.build_vocabulary(lm.count_words(docs))
    assert lm.END in vocabulary.number and 500 < len(vocabulary.words) <= 601
    learned = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in learned for w in [*t.split(), lm.END])
    total, space = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    for r in lm.score_documents(docs).collect():
        words = [*rows[r["doc_id"]][1].split(), lm.END]
        assert r["train_tokens"] == total and r["n_known"] == sum(counts[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(sum(math.log10(counts[w] + 1) - space for w in words), rel=1e-9)
        assert r["score"] < 0


def test_words_are_coded_by_arrow_as_one_by_one(monkeypatch):
    v, counts = tiny(monkeypatch, TEXTS, shared=12)
    words = [*counts, "zebra", "é", "", "ab", "naïveté", "at"]
    number, ending = {w: i for i, w in enumerate(v.words)}, {e: i for i, e in enumerate(v.endings)}
    rank = [number.get(w, -1) for w in words]
    entry = [r if 0 <= r < v.head else v.head + ending.get(w[-3:], len(v.endings)) for r, w in zip(rank, words, strict=True)]
    for given in (words, pa.array(words), pa.array(words, pa.large_string())):
        assert [a.tolist() for a in v.codes(given)] == [rank, entry]


def test_scoring_moves_states_as_training_does(monkeypatch):
    v, _ = tiny(monkeypatch, TEXTS)
    model, rng = lm.GatedModel(v), np.random.default_rng(4)
    for n in (0, 1, 37):
        h, inputs = rng.uniform(-1, 1, (n, lm.HIDDEN)).astype(np.float32), rng.integers(0, v.inputs, n)
        assert np.array_equal(model.state_after(h, inputs), model.step(h, inputs)[0])


def test_training_takes_only_the_words_of_the_network_along(monkeypatch):
    v, counts = tiny(monkeypatch, TEXTS)
    small = v.of_network()
    assert small.words == v.words[: v.head] and len(small.words) < len(v.words)
    words = [*counts, "zebra", ""]
    assert small.codes(words)[1].tolist() == v.codes(words)[1].tolist()
    assert lm.GatedModel(small).packed() == lm.GatedModel(v).packed()


def test_windows_are_learned_as_step_by_step(monkeypatch):
    """The states of a window are those of single steps, to the last bit; cleared where a text begins."""
    v, _ = tiny(monkeypatch, TEXTS)
    model, rng = lm.GatedModel(v), np.random.default_rng(2)
    h = start = rng.uniform(-0.5, 0.5, (7, lm.HIDDEN)).astype(np.float32)
    inputs = rng.integers(0, v.inputs, (5, 7))
    fresh = (rng.random((5, 7)) < 0.7).astype(np.float32)
    for t in range(5):
        h = model.step(h * fresh[t][:, None], inputs[t])[0]
    _, last = model.gradients(start, inputs, fresh, inputs, np.ones((5, 7), np.float32))
    assert np.array_equal(last, h)


def test_a_chunk_is_looked_up_once(monkeypatch):
    """The table of shared words is hashed once a chunk, for its words and the end together."""
    v, _ = tiny(monkeypatch, TEXTS, shared=12)
    model, texts = lm.GatedModel(v), pa.array(["", *TEXTS, None, "  the   cat "])
    calls, codes = [], lm.Vocabulary.codes
    monkeypatch.setattr(lm.Vocabulary, "codes", lambda self, words: (calls.append(len(words)), codes(self, words))[1])
    found = lm.score_chunk(model, v, texts)
    assert len(calls) == 1
    assert found["n_tokens"].to_pylist() == [len(tokens(t)) for t in texts.to_pylist()]
    assert lm.score_chunk(model, v, texts.slice(0, 0))["partial"].to_pylist() == []
