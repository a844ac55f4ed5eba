"""Importance resampling: draw documents whose hashed n-grams look like those of a target set."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.bpe import text_chunks
from tabkit.llm.common import range_ranked, store

#: What separates words: every ASCII character but digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Dictionary index of every word in a row, the offset of each text (one more than texts), and the dictionary."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), SEPARATORS)
    coded = pc.list_flatten(lists).dictionary_encode()
    names = [w.encode() for w in coded.dictionary.to_pylist()]
    indices = np.asarray(coded.indices, np.int64)
    full = np.fromiter((w != b"" for w in names), bool, len(names))
    kept = full[indices] if names else np.empty(0, bool)  # separators at either end of a text leave empty words
    offsets = np.asarray(lists.offsets, np.int64)
    return indices[kept], np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]], names


def ngram_crcs(texts: pa.Array, least: int, most: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text and, for each n from ``least`` to ``most``, the CRC-32 of every n-gram and the offsets of the texts.

    An n-gram is the pair of the (n-1)-gram before and the shifted word index; the CRC of each distinct pair continues
    the CRC of its first part.
    """
    index, offsets, names = text_words(texts)
    words = np.diff(offsets)
    crcs = np.fromiter(map(zlib.crc32, names), np.int64, len(names))
    gram, start, found = index, offsets, []
    for n in range(1, most + 1):
        if n > 1:
            counts = np.maximum(words - n + 1, 0)
            until = np.concatenate([[0], np.cumsum(counts)])
            place = np.arange(until[-1]) - np.repeat(until[:-1], counts)
            first = gram[np.repeat(start[:-1], counts) + place]
            last = index[np.repeat(offsets[:-1], counts) + place + n - 1]
            pairs, gram = np.unique(first * max(1, len(names)) + last, return_inverse=True)
            before, word = np.divmod(pairs, max(1, len(names)))
            crcs = np.fromiter(
                (zlib.crc32(b" " + names[w], c) for c, w in zip(crcs[before].tolist(), word.tolist(), strict=True)), np.int64, len(pairs)
            )
            start = until
        if n >= least:
            found.append((crcs[gram] if len(gram) else np.empty(0, np.int64), start))
    return words, found


def bucket_counts(df: DataFrame, text_column: str = "text", buckets: int = BUCKETS, least: int = 1, most: int = 1) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket; tasks send one count per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                for crc, _ in ngram_crcs(chunk["text"], least, most)[1]:
                    counts += np.bincount(crc % buckets, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.record_batch({"bucket": pa.array(used), "n": pa.array(counts[used])})

    texts = df.select(F.col(text_column).cast("string").alias("text"))
    out = np.zeros(buckets, np.int64)
    for row in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target to source share of each bucket, rounded down."""
    width, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_source + width) / ((s + 1) * (all_target + width))))
            for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)
        ],
        np.int64,
    )


def document_weights(
    df: DataFrame, gains: np.ndarray, id_column: str = "doc_id", text_column: str = "text", least: int = 1, most: int = 1
) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row: the gains of its n-grams, summed text by text."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                words, found = ngram_crcs(chunk["text"], least, most)
                features, weight = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
                for crc, start in found:
                    total = np.concatenate([[0], np.cumsum(gains.take(crc % buckets))])
                    features += np.diff(start)
                    weight += total[start[1:]] - total[start[:-1]]
                yield pa.record_batch(
                    {
                        "doc_id": chunk["doc_id"],
                        "n_words": pa.array(words, pa.int64()),
                        "n_features": pa.array(features),
                        "weight": pa.array(weight),
                    }
                )

    rows = df.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    ngrams: tuple[int, int] = (1, 1),
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``: a draw of documents that resemble ``target``.

    Only A-Z are lower-cased; words are runs of digits, a-z and non-ASCII characters. Features are all runs of
    ``ngrams`` consecutive words, in CRC-32 buckets; ``weight`` sums the floored log ratios of the buckets' shares in all of
    ``target`` and all of ``docs``. ``score`` adds Gumbel noise from a hash of seed and id, so the highest scores are a draw
    without replacement in proportion to the importance weights. Of the rows with at least ``least_words`` words the highest
    ``percent`` per cent (rounded down) are drawn and get ranks 1, 2, 3, ...; equal scores go by the smaller id.

    The driver holds one count per bucket. Null text counts as empty, with weight 0; a null id is hashed as no text and goes
    before others in ties; repeated rows are scored and ranked one by one; either table may be empty. Other columns are ignored.
    """
    least, most = ngrams
    gains = bucket_gains(bucket_counts(docs, text_column, buckets, least, most), bucket_counts(target, target_text, buckets, least, most))
    weights = document_weights(docs, gains, id_column, text_column, least, most)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = store(weights.withColumn("score", (F.col("weight") + noise).cast("long")), "scored")
    able = F.col("n_words") >= least_words
    n = scored.where(able).count()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("n_words")]
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = range_ranked(scored.where(able), order, n, "rank").select(
        *columns, F.when(F.col("rank") <= percent * n // 100, F.col("rank")).alias("rank")
    )
    return ranked.unionByName(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))
