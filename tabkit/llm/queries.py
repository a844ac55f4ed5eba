"""Named queries of the operators, each over its whole table, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm import chat_format, decontamination, importance, language_id, lm_scoring, near_dedup, pii, prefix_trie, quality, sharding, token_output, topk, vector_packing
from tabkit.llm.common import id_remainder, store, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_gated_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, folder, "documents"))


def op2_chat_hmm(spark: SparkSession, folder: str) -> DataFrame:
    """Transcripts in mixed marker styles made of all conversations; the model is fitted on four of five of them."""
    raw = chat_format.as_transcript(table(spark, folder, "conversations"))
    known = chat_format.transcript_lines(raw.where(id_remainder("conv_id", 5) != 2), "conv_id", "turn", "text", "role")
    return chat_format.canonical_turns(raw, chat_format.fit_chat_model(known))


def op3_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_output.packed_matrices(table(spark, folder, "documents"), TOKENIZER)


def op4_simhash_windows(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = vector_packing.pack_documents(table(spark, folder, "documents"), TOKENIZER)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_language_family(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_predictions(table(spark, folder, "documents"))


def op7_quality_qda(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(table(spark, folder, "documents"))


def op9_stratified_shards(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.stratified_shards(table(spark, folder, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source")


def op10_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.exact_topk(vectors, F.col("vec_id") % 50 == 0)


def op11_semi_markov_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.span_digests(pii.personal_spans(docs, pii.fit_span_field(docs)))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = store(prefix_trie.numbered_turns(table(spark, folder, "conversations")), "turns")
    return prefix_trie.trie_digests(prefix_trie.prefix_trie(*prefix_trie.grafted(turns)))


def op13_importance_draw(spark: SparkSession, folder: str) -> DataFrame:
    return importance.importance_resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_gated_lm, op2_chat_hmm, op3_token_output, op4_simhash_windows, op5_vector_packing, op6_language_family, op7_quality_qda, op8_dart_minhash,
        op9_stratified_shards, op10_exact_topk, op11_semi_markov_pii, op12_prefix_trie, op13_importance_draw,
    )
}

#: CRC-32 of the ASCII or UTF-8 bytes of every row (k, hex) of a preceding table ``coded``; gives ``crcs (k, crc)``.
_CRC32 = """
bits AS (
  SELECT range AS byte, 0 AS step, range AS v FROM range(256)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE step < 8
), places AS (SELECT byte, v FROM bits WHERE step = 8), walk AS (
  SELECT k, hex, 0 AS i, 4294967295::BIGINT AS crc FROM coded
  UNION ALL
  SELECT k, hex, i + 1, xor(crc >> 8, p.v)
  FROM walk JOIN places p ON p.byte = xor(crc & 255, ('0x' || substr(hex, 2 * i + 1, 2))::BIGINT)
  WHERE 2 * i < length(hex)
), crcs AS (SELECT k, xor(crc, 4294967295) AS crc FROM walk WHERE 2 * i = length(hex))
"""

SQL: dict[str, str] = {
    "op12_prefix_trie": """
WITH RECURSIVE own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), coded AS (SELECT DISTINCT conv_id AS k, hex(encode(conv_id::VARCHAR)) AS hex FROM own), """
    + _CRC32
    + """, heads AS (SELECT k AS c, k - k % 100 AS first, crc % 6 AS h FROM crcs), rebuilt AS (
  SELECT c, p, role, text FROM heads JOIN own ON own.conv_id = first AND p <= h
  UNION ALL
  SELECT c, p, role, text FROM heads JOIN own ON own.conv_id = c AND p > h
), turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS p, sha256(length(role) || ':' || role || text) AS t, length(text) AS n FROM rebuilt
), paths AS (
  SELECT c, 0::BIGINT AS depth, '' AS path, '' AS up, 0::BIGINT AS n FROM heads
  UNION ALL
  SELECT c, p, string_agg(t, '/') OVER w, coalesce(string_agg(t, '/') OVER (PARTITION BY c ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), n
  FROM turns WINDOW w AS (PARTITION BY c ORDER BY p)
), lengths AS (SELECT c, max(depth) AS last FROM paths GROUP BY c), nodes AS (
  SELECT path, depth, any_value(up) AS up, any_value(n) AS n, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM paths JOIN lengths USING (c) GROUP BY path, depth
), kids AS (SELECT up AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL), marked AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path, depth)
), trees AS (
  SELECT p.path, p.depth, sum((m.n_convs - 1) * m.n)::BIGINT AS saved_tokens, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves
  FROM marked m JOIN paths q ON q.c = m.conv_id AND q.depth = m.depth JOIN paths p ON p.c = m.conv_id AND p.depth <= m.depth GROUP BY ALL
)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, t.n_leaves, t.saved_tokens, m.ends_sha256
FROM marked m JOIN trees t USING (path, depth) LEFT JOIN marked u ON u.path = m.up AND u.depth = m.depth - 1
""",
    "op13_importance_draw": r"""
WITH RECURSIVE words AS (
  SELECT true AS own, doc_id, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM documents
  UNION ALL
  SELECT false, item_id, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
  FROM benchmark
), coded AS (SELECT DISTINCT w AS k, hex(encode(w)) AS hex FROM words WHERE w <> ''), """
    + _CRC32
    + """, placed AS (SELECT own, doc_id, crc % 10000 AS b FROM words JOIN crcs ON k = w),
held AS (SELECT b, count(*) FILTER (WHERE own) AS s, count(*) FILTER (WHERE NOT own) AS t FROM placed GROUP BY b),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM held),
gains AS (
  SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM held, sums
), weights AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight FROM placed JOIN gains USING (b) WHERE own GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND r <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN r END AS rank
FROM ranked
""",
    "op4_simhash_windows": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), ds AS (
  SELECT doc_id, len(w) AS n, p, list_slice(w, p + 1, p + 5) AS s FROM d, unnest(range(0, len(w) - 4)) AS t(p)
), its AS (
  SELECT item_id, len(w) AS n, p, list_slice(w, p + 1, p + 5) AS s FROM i, unnest(range(0, len(w) - 4)) AS t(p)
), win AS (
  SELECT DISTINCT ds.doc_id, its.item_id, greatest(0, ds.p - its.p) AS a, least(ds.n, ds.p - its.p + its.n) AS z, its.n AS n
  FROM ds JOIN its ON ds.s = its.s
), wc AS (
  SELECT win.doc_id, win.item_id, a, z, win.n, ds.s, count(*) AS c
  FROM win JOIN ds ON ds.doc_id = win.doc_id AND ds.p BETWEEN a AND z - 5 GROUP BY ALL
), ic AS (SELECT item_id, s, count(*) AS c FROM its GROUP BY ALL), sim AS (
  SELECT doc_id, wc.item_id, a, z, n, sum(least(wc.c, coalesce(ic.c, 0))) AS shared
  FROM wc LEFT JOIN ic ON ic.item_id = wc.item_id AND ic.s = wc.s GROUP BY ALL
), r AS (
  SELECT doc_id, item_id, CAST(shared AS DOUBLE) / CAST(z - a - 4 + n - 4 - shared AS DOUBLE) AS similarity, a AS start FROM sim
)
SELECT doc_id, item_id, max(similarity) AS similarity, CAST(arg_min(start, (-similarity, start)) AS INTEGER) AS start
FROM r WHERE similarity >= 0.8 GROUP BY doc_id, item_id
""",
    "op10_exact_topk": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT * FROM r WHERE rank <= 5
""",
}
