import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabkit.llm import bpe, sharding, token_output, topk, vector_packing
from tabkit.llm.queries import QUERIES, SQL, TOKENIZER

SMALL = "/root/testdata/sf0.001"


def expected_ids(text):
    full = Tokenizer.from_file(TOKENIZER)
    return [*full.encode(text or "", add_special_tokens=False).ids, 1]


def test_word_ids_equal_the_library(spark):
    import pyarrow as pa
    from tests.llm.conftest import HARD

    texts = [t for _, t, _, _ in HARD]
    texts += [r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    ids, offsets = bpe.WordEncoder(TOKENIZER).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == expected_ids(text)[:-1]


def test_word_memory_is_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    words = bpe.WordEncoder(TOKENIZER)
    for text in ("a b c d", "e f g", "a bird flew over it all"):
        ids, _ = words.encode(pa.array([text]))
        assert ids.tolist() == expected_ids(text)[:-1]
        assert len(words.index) <= 6


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_pack_keeps_every_id_and_capacity(spark, hard, rule):
    pieces = vector_packing.token_pieces(hard, TOKENIZER, most=64)
    rows = vector_packing.pack_vectors(pieces, tokens=64, documents=3, attention=5000.0, rule=rule).collect()
    from tests.llm.conftest import HARD

    want = []
    for doc, text, _, _ in HARD:
        ids = expected_ids(text)
        for p, start in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[start : start + 64], "<u4").tobytes()
            want.append((doc, p, start, len(part) // 4, zlib.crc32(part)))
    assert sorted([r[:5] for r in rows], key=str) == sorted(want, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        members.sort(key=lambda r: r.offset)
        assert [r.offset for r in members] == [0, *np.cumsum([r.length for r in members])[:-1].tolist()]
        assert sum(r.length for r in members) <= 64
        assert len(members) <= 3
        assert sum(r.length**2 for r in members) <= 5000


def test_pack_refuses_what_cannot_fit(spark, hard):
    pieces = vector_packing.token_pieces(hard, TOKENIZER, most=64)
    with pytest.raises(Exception, match="exceeds a capacity"):
        vector_packing.pack_vectors(pieces, tokens=32).collect()


def test_few_sequences(spark):
    rows = QUERIES["op5_vector_packing"](spark, SMALL).collect()
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 4096) + 1


def test_best_fit_against_plain_search():
    rng = np.random.default_rng(3)
    sizes = np.column_stack([rng.integers(1, 60, 300), np.ones(300), rng.integers(1, 900, 300)]).astype(float)
    capacity, weights = np.array([100.0, 5.0, 1500.0]), np.array([1.0, 0.2, 0.5])
    for rule in ("dot", "norm"):
        bins, _ = vector_packing.best_fit(sizes, capacity, weights, rule)
        unit = sizes / capacity
        room, want = [], np.empty(300, int)
        for i in np.lexsort((-unit.max(axis=1), -(unit @ weights))):
            scores = [
                (-(r * weights * unit[i]).sum() if rule == "dot" else (weights * (r - unit[i]) ** 2).sum(), b)
                for b, r in enumerate(room)
                if (r - unit[i] >= -1e-12).all()
            ]
            if not scores:
                room.append(np.ones(3))
            b = min(scores)[1] if scores else len(room) - 1
            room[b] = room[b] - unit[i]
            want[i] = b
        used = np.zeros((bins.max() + 1, 3))
        np.add.at(used, bins, sizes)
        assert (used <= capacity + 1e-6).all()
        assert bins.max() == want.max()


def test_matrices_round_trip(spark, hard):
    from tests.llm.conftest import HARD

    rows = token_output.packed_matrices(hard, TOKENIZER, most=64, pad_id=9).collect()
    found = []
    for r in rows:
        ids = np.frombuffer(r.input_ids, f"<u{r.id_bytes}")
        assert len(ids) == 64
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert r.cu_seqlens[:-1] == r.position_resets
        assert (ids[r.n_tokens :] == 9).all()
        for doc, piece, start, a, b in zip(r.doc_ids, r.pieces, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            found.append((doc, piece, start, ids[a:b].tolist()))
    want = []
    for doc, text, _, _ in HARD:
        ids = expected_ids(text)
        want += [(doc, p, s, ids[s : s + 64]) for p, s in enumerate(range(0, len(ids), 64))]
    assert sorted(found, key=str) == sorted(want, key=str)
    row = spark.createDataFrame(rows[:1], token_output._ROW).select(
        token_output.position_ids(F.col("position_resets"), F.col("n_tokens")).alias("p"), "cu_seqlens"
    ).first()
    assert row.p == [i for a, b in zip(row.cu_seqlens, row.cu_seqlens[1:], strict=False) for i in range(b - a)]


def test_capacity_tree_and_best_fit_decreasing():
    rng = random.Random(5)
    lengths = [rng.randint(1, 40) for _ in range(500)]
    bins = token_output.best_fit_decreasing(np.array(lengths), 50)
    free, want = [], [0] * 500
    for i in sorted(range(500), key=lambda i: -lengths[i]):
        room = [f for f in free if f >= lengths[i]]
        if room:
            free[free.index(min(room))] -= lengths[i]
        else:
            free.append(50 - lengths[i])
    used = np.bincount(bins, lengths)
    assert used.max() <= 50 and sorted(50 - used) == sorted(free)
    assert len(want) == 500


def test_shards_match_the_mixture(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 37)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.withColumn("source", F.expr("CASE WHEN doc_id % 3 = 0 THEN 'hot' WHEN doc_id % 7 = 0 THEN NULL ELSE source END"))
    rows = sharding.stratified_shards(docs, shards=7).collect()
    texts = dict(docs.select("doc_id", "text").collect())
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by_shard, by_source = {}, {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        by_shard.setdefault(r.shard, []).append(r)
        by_source.setdefault(r.source, []).append(r)
    counts = [len(v) for v in by_shard.values()]
    assert len(counts) == 7 and max(counts) - min(counts) <= 1
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        for source, everywhere in by_source.items():
            share = len(everywhere) / len(rows) * len(members)
            assert abs(sum(r.source == source for r in members) - share) <= 3
    # the same by plain sorting
    order = []
    for source, members in by_source.items():
        phase = draw_of(f"17:phase:{int(source is None)}:{source or ''}") / 2.0**60
        keyed = [(draw_of(f"17:{r.doc_id}:{r.text_crc32}:{r.size}"), r.doc_id) for r in members]
        for k, (d, i) in enumerate(sorted(keyed)):
            order.append(((k + phase) / len(members), d, i))
    place = {i: p for p, (_, _, i) in enumerate(sorted(order))}
    assert all(r.shard == place[r.doc_id] * 7 // len(rows) for r in rows)


def draw_of(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_shards_take_hard_rows(spark, hard, nothing, tmp_path):
    rows = sharding.stratified_shards(hard, shards=4).collect()
    assert len(rows) == 10 and sorted(r.shard for r in rows) == [0, 0, 0, 1, 1, 2, 2, 2, 3, 3]
    assert sharding.stratified_shards(nothing).count() == 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sharding.write_shards(sharding.stratified_shards(docs, shards=3), docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 3


def vectors(spark):
    rows = [(i, [float((i * 7 + j * 3) % 11) / 8 - 0.5 for j in range(4)], "x") for i in range(120)]
    rows += [(200, [1.0, 2.0], "y"), (250, [0.5, 1.0], "y"), (300, None, "n"), (350, [1.0, None, 0.0, 0.0], "n")]
    rows += [(400, [float("nan"), 0.0, 0.0, 0.0], "n"), (None, [1.0, 1.0, 1.0, 1.0], "n"), (450, [float("inf")] * 4, "n")]
    rows += [rows[3], rows[50], (500, [1e30, -1e30, 0.0, 1.0], "big"), (500, [0.0, 0.0, 0.0, 1.0], "again")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), rows


def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    df, rows = vectors(spark)
    got = topk.exact_topk(df, F.col("vec_id") % 50 == 0).collect()
    good = {(i, tuple(v)) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in good]
    want = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        best = {}
        for i, v in whole:
            if i == q:
                continue
            for j, w in whole:
                if j == q and len(w) == len(v):
                    s = max(min(sum(a * b for a, b in zip(v, w, strict=True)), topk.LONG), -topk.LONG)
                    best[i] = max(best.get(i, s), s)
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5], 1):
            want.append((q, rank, i, s))
    assert sorted(tuple(r) for r in got) == want


def test_topk_of_nothing(spark):
    df, _ = vectors(spark)
    assert topk.exact_topk(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.exact_topk(df.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    rows = QUERIES["op10_exact_topk"](spark, SMALL).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in rows) == sorted(con.execute(SQL["op10_exact_topk"]).fetchall())


def test_no_exchange_is_on_the_source_alone(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'x' AS text", "if(id % 3 = 0, 'hot', concat('s', id % 10)) AS source")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = sharding.stratified_shards(docs)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert dealt.groupBy("shard").count().agg({"count": "max"}).first()[0] == 125
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(bare" not in plan.replace("hashpartitioning(bare, stratum, slice", "")
