from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabkit.llm import near_dedup, shingles

SMALL = "/root/testdata/sf0.001"


def weighted(text, width=5):
    words = (text or "").lower().split()
    runs = [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    return {r: runs.count(r) for r in runs}


def similarity(a, b):
    keys = set(a) | set(b)
    top = sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / top if top else 0.0


def classes(texts, least=0.8):
    bags = {i: weighted(t) for i, t in texts.items()}
    up = {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = {}
    for i in sorted(texts):
        for r in bags[i]:
            holders.setdefault(r, []).append(i)
    sharing = {p for ids in holders.values() for p in combinations(ids, 2)}  # others have similarity 0
    for a, b in sorted(sharing):
        if similarity(bags[a], bags[b]) >= least:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: root(i) for i in texts}


def crowd(n, seed=0):
    """Chains of drifting texts, near copies of one text, exact copies, and texts that share a passage."""
    rng = np.random.default_rng(seed)
    word = lambda: "w%d" % rng.integers(10_000)
    base = [word() for _ in range(60)]
    texts = [list(base)]
    for _ in range(n):  # a chain: each text differs a little from the one before
        last = list(texts[-1])
        last[rng.integers(0, 60)] = word()
        texts.append(last)
    for _ in range(n):  # near copies of the first text
        copy = list(base)
        copy[rng.integers(0, 60)] = word()
        texts.append(copy)
    texts += [list(base)] * 5
    passage = [word() for _ in range(25)]
    texts += [passage + [word() for _ in range(12)] for _ in range(n)]
    order = rng.permutation(len(texts))
    return {int(i): " ".join(texts[j]) for i, j in enumerate(order)}


def test_similarity_of_cells():
    texts = ["a b c d e f a b c d e f", "a b c d e f", "A  b c\nd e", "x y", None, "", "x y z"]
    words, offsets, digests = shingles.text_words(pa.array(texts))
    cell, until = shingles.cells(words, offsets, 5)
    sets = [cell[a:b] for a, b in zip(until, until[1:], strict=False)]
    for i, j in combinations(range(len(texts)), 2):
        same = shingles.common(sets[i], sets[j])
        union = len(sets[i]) + len(sets[j]) - same
        assert (same / union if union else 0.0) == pytest.approx(similarity(weighted(texts[i]), weighted(texts[j])))
    assert digests[4] is None and digests[5] is None and len(set(digests[:4])) == 4


def test_signatures_estimate_weighted_jaccard():
    texts = list(crowd(12).values()) + ["a b c", "a b c", "one", ""]
    words, offsets, _ = shingles.text_words(pa.array(texts))
    cell, until = shingles.cells(words, offsets, 5)
    table = near_dedup.dart_signatures(cell, until, 512)
    assert (table[-1] == near_dedup._NONE).all() and (table[:-1] != near_dedup._NONE).all()
    for i, j in combinations(range(len(texts) - 1), 2):
        assert (table[i] == table[j]).mean() == pytest.approx(similarity(weighted(texts[i]), weighted(texts[j])), abs=0.12)
    alone = near_dedup.dart_signatures(cell[until[3] : until[4]], np.array([0, until[4] - until[3]]), 512)
    assert (alone[0] == table[3]).all()


def test_classes_against_all_pairs(spark):
    texts = crowd(40)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert dict(near_dedup.near_duplicate_classes(rows).collect()) == classes(texts)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert dict(near_dedup.near_duplicate_classes(docs).collect()) == classes(dict(docs.select("doc_id", "text").collect()))


def test_classes_of_hard_rows(spark, hard, nothing):
    rows = near_dedup.near_duplicate_classes(hard).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in rows) == [
        (0, 0), (1, 1), (1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (6, 6), (7, 7), (8, 8),
    ]
    assert near_dedup.near_duplicate_classes(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (100, 102), (7, 3)], "a long, b long")
    labels = dict(near_dedup.components(edges).collect())
    assert labels == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert near_dedup.components(edges.where(F.lit(False))).count() == 0


def test_texts_on_one_base_are_not_compared_pair_by_pair(spark, monkeypatch):
    """2000 texts that share a base and are mutually just below the threshold, and two pairs of real copies among them."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(2000):
        words = base.copy()
        for at in rng.choice(40, 5, replace=False) * 5:
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words)))
    rows += [(5000, rows[7][1] + " end"), (5001, rows[9][1] + " end")]
    compared = []
    similarities = near_dedup._similarities

    def counted(pairs, known):
        compared.append(pairs.count())
        return similarities(pairs, known)

    monkeypatch.setattr(near_dedup, "_similarities", counted)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[5000] == 7 and got[5001] == 9 and sum(i != c for i, c in got.items()) == 2
    assert sum(compared) < 100_000


def test_rows_that_share_an_id_are_kept_by_text(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, one), (1, two), (1, two), (2, one), (3, three), (None, three), (None, None), (None, "d e f"), (None, "d e f"), (4, "")]
    kept = near_dedup.keep_one(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _id string"))
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert [t for _, t in got].count(one) == 1 and [t for _, t in got].count(two) == 1
    assert (3, three) in got and (None, three) not in got and (4, "") in got and (None, None) in got
    assert [t for _, t in got].count("d e f") == 1 and len(got) == 6
