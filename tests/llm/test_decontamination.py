import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.llm import decontamination as dc
from tabkit.llm.queries import QUERIES, SQL

MEDIUM = "/root/testdata/sf0.01"


def bag(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs, items, cut_at_ends, least=0.8):
    """Best window of every document and item: windows of the item's size inside the text, or also cut at its ends."""
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out, bags = {}, {}
    for d, text in docs:
        w = cut(text)
        bags[d] = bag(w)
        for i, item in items:
            v = cut(item)
            if len(v) < 5 or len(w) < 5:
                continue
            want = bag(v)
            if not want.keys() & bags[d].keys():  # similarity 0 everywhere
                continue
            for s in range(-len(v), len(w)) if cut_at_ends else range(max(1, len(w) - len(v) + 1)):
                window = w[max(0, s) : s + len(v)] if s + len(v) > 0 else []
                have = bag(window)
                both = sum((want & have).values())
                sim = both / (sum(want.values()) + sum(have.values()) - both)
                if sim >= least and sim > out.get((d, i), (0, 0))[0] + 1e-12:
                    out[d, i] = (sim, max(0, s))
    return out


def planted():
    rng = np.random.default_rng(4)
    word = lambda: "w%d" % rng.integers(500)
    items = [(k, [word() for _ in range(size)]) for k, size in enumerate((5, 9, 15, 40, 40, 60, 60))]
    docs = []
    for k, v in items:
        for edit in range(6):
            copy = list(v)
            if edit in (1, 2):
                copy[rng.integers(len(copy))] = word()
            if edit == 3:
                copy.insert(rng.integers(len(copy)), word())
            if edit == 4:
                del copy[rng.integers(len(copy))]
            around = [word() for _ in range(20 * (edit % 3))]
            docs.append((100 * k + edit, " ".join(around + [c.upper() + "," for c in copy] + around)))
    docs += [(900, " ".join(items[3][1] * 2)), (901, " ".join(word() for _ in range(300))), (902, "a b c")]
    return docs, [(k, " ".join(v)) for k, v in items] + [(77, "too short"), (78, None)]


def test_windows_against_brute_force(spark):
    docs, items = planted()
    got = dc.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    inside, any_cut = brute(docs, items, False), brute(docs, items, True)
    found = {(r.doc_id, r.item_id): r.similarity for r in got}
    assert set(inside) <= set(found) <= set(any_cut) and len(inside) > 20
    for pair, sim in found.items():
        assert inside.get(pair, (0,))[0] - 1e-9 <= sim <= any_cut[pair][0] + 1e-9


def test_hard_rows(spark, hard, nothing):
    items = spark.createDataFrame(
        [(1, "cat sat on the mat and it s 42 cats"), (None, "camino de los árboles la palabra"), (2, ""), (3, None), (1, "cat sat on the mat and it s 42 cats")],
        "item_id long, text string",
    ).withColumn("words", F.lit(1))
    rows = dc.contaminated(hard, items).collect()
    assert sorted((r.doc_id, r.item_id or 0, r.similarity) for r in rows) == [(1, 1, 1.0), (5, 1, 1.0), (8, 0, 1.0)]
    assert dc.contaminated(nothing, items).count() == 0
    assert dc.contaminated(hard, items.where("false")).count() == 0


def test_blocks_reach_the_radius(spark):
    rng = np.random.default_rng(0)
    values = set(dc._near_values())
    for _ in range(2000):
        bits = rng.choice(64, rng.integers(0, dc.RADIUS + 1), replace=False)
        blocks = [sum(1 << int(b) % 8 for b in bits if b // 8 == k) for k in range(8)]
        assert any(b in values for b in blocks)


def test_simhash_of_features(spark):
    rows = spark.createDataFrame([([1, 2, 3, 3, -1],), ([-1],), ([],)], "h array<long>")
    got = [r[0] for r in rows.select(dc.simhash(F.col("h"))).collect()]
    assert got == [3, -1, 0]


def test_no_python_on_executors(spark):
    docs, items = spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    plan = dc.contaminated(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{MEDIUM}/{name}.parquet')")
    want = con.execute(SQL["op4_simhash_windows"]).fetchall()
    rows = QUERIES["op4_simhash_windows"](spark, MEDIUM).select("doc_id", "item_id", "similarity", "start").collect()
    assert sorted(tuple(r) for r in rows) == sorted(want) and len(want) > 20


def test_long_texts_cross_no_join_with_their_words(spark):
    item = " ".join(f"w{i}" for i in range(40))
    filler = "la palabra y el camino de los árboles " * 3000
    rows = [(i, filler + item + " " + filler) for i in range(5)] + [(100, filler)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame([(1, item), (2, "la palabra y el camino de los árboles la palabra y el")], "item_id long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dc.contaminated(docs, benchmark)
        got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {**{(i, 1): (1.0, 24_000) for i in range(5)}, **{(i, 2): (1.0, 0) for i in [*range(5), 100]}}


def test_only_the_text_with_the_leak_goes(spark):
    item = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"a b {item}", "x"), (1, "another text", "y"), (None, item, "z"), (None, "clean", "u"), (None, None, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string")
    kept = dc.without_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(r["size"] for r in kept.collect()) == ["u", "v", "y"]
