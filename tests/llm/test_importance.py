import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tabkit.llm import importance

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, least, most):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)) if w]
    runs = [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def plain(docs, target, least=1, most=1, buckets=10_000, least_words=20, percent=10, seed=2024):
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    own = Counter(bucket(r) for _, t in docs for r in features(t, least, most)[1])
    wanted = Counter(bucket(r) for t in target for r in features(t, least, most)[1])
    s_all, t_all = float(sum(own.values())), float(sum(wanted.values()))
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((own[b] + 1) * (t_all + buckets))))
    rows = []
    for i, t in docs:
        words, runs = features(t, least, most)
        weight = sum(gain(bucket(r)) for r in runs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is not None, r[0], r[2]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((r[0], *r[2:], drawn.get(id(r))) for r in rows), key=str)


def test_draw_equals_plain_version(spark, hard):
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = sample.unionByName(hard.withColumn("doc_id", F.col("doc_id") + 1_000_000).select("doc_id", "text"))
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    texts = [r["text"] for r in target.collect()]
    for grams in [(1, 1), (1, 3), (2, 2)]:
        got = importance.importance_resample(docs, target, ngrams=grams)
        assert sorted(map(tuple, got.collect()), key=str) == plain(pairs, texts, *grams)


def test_many_ranges_give_the_same_ranks(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat('w', id % 7, ' '), 20 + id % 3) AS text")
    target = spark.createDataFrame([("w1 w1 w2",)], "text string")
    want = importance.importance_resample(docs, target, percent=50)
    monkeypatch.setattr("tabkit.llm.common.RANGE_ROWS", 200)
    got = importance.importance_resample(docs, target, percent=50)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert sorted(r["rank"] for r in got.where("rank IS NOT NULL").collect()) == list(range(1, 1501))


def test_hard_rows(hard, nothing):
    got = {(r["doc_id"], r["n_features"]): r for r in importance.importance_resample(hard, hard, percent=100).collect()}
    assert [got[(i, 0)]["weight"] for i in (2, 3, 4)] == [0, 0, 0]
    assert got[(8, 24000)]["rank"] is not None and got[(1, 11)]["rank"] is None
    assert importance.importance_resample(nothing, hard).collect() == []
    assert importance.importance_resample(hard, nothing).count() == hard.count()
    named = hard.selectExpr("CAST(doc_id AS STRING) AS name", "text AS body", "doc_id", "text")
    assert importance.importance_resample(named, hard, id_column="name", text_column="body").count() == hard.count()
