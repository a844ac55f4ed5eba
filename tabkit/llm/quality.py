"""Quality of documents by a regularised quadratic discriminant over text statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.bpe import text_chunks
from tabkit.llm.common import id_remainder, store

STATISTICS = (
    "words", "word_length", "upper", "digits", "symbols", "shouts", "stops", "distinct_words", "repeated_runs",
    "repeated_lines", "line_length", "short_words", "marked_words",
)
PASS = 0.7
CHUNK_BYTES = 2 << 20


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _distinct(codes: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """Number of different codes in each text."""
    pairs = texts.astype(np.int64) * (int(codes.max(initial=0)) + 1) + codes
    pairs.sort()
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = pairs[1:] != pairs[:-1]
    return np.bincount(pairs[fresh] // (int(codes.max(initial=0)) + 1), minlength=n).astype(float)


def text_statistics(texts: pa.Array) -> np.ndarray:
    """Transformed statistics of whole texts, one column for each of ``STATISTICS``.

    Counts go through log(1 + x) and shares through the square root, which brings them nearer to a normal shape.
    Null counts as empty; an empty text has zero everywhere.
    """
    texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.empty((0, len(STATISTICS)))
    raw = pc.cast(texts, pa.binary())
    sizes = np.asarray(pc.binary_length(raw), np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    byte = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
    kind = np.zeros(256, np.uint8)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 2
    for chars, k in (("!?", 4), (".,;:'\"-()", 5), ("#$%&*+/<=>@[\\]^_`{|}~", 6)):
        kind[list(chars.encode())] = k
    kinds = kind[byte]
    upper, lower, digit, shout, stop, symbol = (_per_text(kinds == k, at) for k in range(1, 7))
    ink = np.maximum(1, upper + lower + digit + shout + stop + symbol)
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    word_at = np.asarray(lists.offsets, np.int64)
    word_at = word_at - word_at[0]
    codes = np.asarray(coded.indices, np.int64)
    names = pc.cast(coded.dictionary, pa.binary())
    length = np.asarray(pc.binary_length(names), np.int64)
    marked = np.asarray(pc.match_substring_regex(coded.dictionary, r"[#$%&*!]{2,}"), bool)
    words = _per_text((length > 0)[codes], word_at) if len(codes) else np.zeros(n)
    some = np.maximum(1, words)
    of_text = np.repeat(np.arange(n), np.diff(word_at))
    runs = np.empty(0, np.int64)
    run_text = np.empty(0, np.int64)
    if len(codes) > 4:
        mix = codes.astype(np.uint64)
        value = sum(mix[j : len(mix) - 4 + j] * np.uint64(m) for j, m in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)))
        whole = of_text[4:] == of_text[:-4]
        runs, run_text = np.unique(value[whole], return_inverse=True)[1], of_text[:-4][whole]
    run_count = np.bincount(run_text, minlength=n).astype(float)
    repeated = 1 - _distinct(runs, run_text, n) / np.maximum(1, run_count) * (run_count > 0) - (run_count == 0)
    lines = pc.split_pattern(texts, "\n")
    line_codes = lines.flatten().dictionary_encode()
    line_at = np.asarray(lines.offsets, np.int64)
    line_count = np.diff(line_at).astype(float)
    line_text = np.repeat(np.arange(n), np.diff(line_at))
    line_distinct = _distinct(np.asarray(line_codes.indices, np.int64), line_text, n)
    columns = [
        np.log1p(words),
        np.log1p(sizes / some),
        np.sqrt(upper / ink),
        np.sqrt(digit / ink),
        np.sqrt(symbol / ink),
        np.sqrt(shout / ink),
        np.sqrt(stop / ink),
        np.sqrt(_distinct(codes, of_text, n) / some),
        np.sqrt(np.clip(repeated, 0, 1)),
        np.sqrt(np.clip(1 - line_distinct / np.maximum(1, line_count), 0, 1)),
        np.log1p(sizes / np.maximum(1, line_count)),
        np.sqrt(_per_text(((length > 0) & (length <= 3))[codes], word_at) / some) if len(codes) else np.zeros(n),
        np.sqrt(_per_text(marked[codes], word_at) / some) if len(codes) else np.zeros(n),
    ]
    out = np.column_stack(columns)
    out[words == 0] = 0.0
    return out


@dataclass
class QualityModel:
    """Two Gaussian classes; ``inverse`` holds the inverted Cholesky factors of their covariances."""

    mean: np.ndarray
    inverse: np.ndarray
    constant: float

    @classmethod
    def fit(cls, count: np.ndarray, total: np.ndarray, product: np.ndarray, shrink: float = 0.1, floor: float = 1e-3) -> QualityModel | None:
        """From counts, sums and sums of products of class 0 and class 1; None if a class has under two rows.

        Each covariance is shrunk by ``shrink`` towards the pooled one, which is itself shrunk towards its diagonal.
        """
        if count.min() < 2:
            return None
        mean = total / count[:, None]
        own = product / count[:, None, None] - mean[:, :, None] * mean[:, None, :]
        pooled = (own * count[:, None, None]).sum(axis=0) / count.sum()
        pooled = (1 - shrink) * pooled + shrink * np.diag(np.diag(pooled)) + floor * np.eye(len(pooled))
        factors = [np.linalg.cholesky((1 - shrink) * c + shrink * pooled) for c in own]
        log_det = [2 * np.log(np.diag(f)).sum() for f in factors]
        constant = np.log(count[1] / count[0]) - 0.5 * (log_det[1] - log_det[0])
        return cls(mean, np.array([np.linalg.inv(f) for f in factors]), float(constant))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of squared Mahalanobis distances."""
        distance = [(((x - m) @ f.T) ** 2).sum(axis=1) for m, f in zip(self.mean, self.inverse, strict=True)]
        return 1 / (1 + np.exp(-np.clip(self.constant - 0.5 * (distance[1] - distance[0]), -700, 700)))


def statistics_table(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and the statistics ``x`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", CHUNK_BYTES):
                x = text_statistics(chunk["text"])
                offsets = pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32())
                yield pa.record_batch({"doc_id": chunk["doc_id"], "x": pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1), pa.float64()))})

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


def fit_quality_model(statistics: DataFrame, labels: DataFrame, fold: tuple[int, int] = (4, 2), label_column: str = "quality") -> QualityModel | None:
    """Fit on all labelled rows outside the held-out fold; counts and sums are one aggregation, nothing is sampled."""
    known = labels.where(F.col(label_column).isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder("doc_id", fold[0]) != fold[1]))
    rows = statistics.join(known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("label")), "doc_id")
    d = len(STATISTICS)
    x = [F.col("x")[i] for i in range(d)]
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("label").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("total"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in upper]).alias("product"),
    )
    count, total, product = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in sums.collect():
        count[r["label"]], total[r["label"]] = r["n"], r["total"]
        for (i, j), v in zip(upper, r["product"], strict=True):
            product[r["label"], i, j] = product[r["label"], j, i] = v
    return QualityModel.fit(count, total, product)


def quality_scores(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", fold: tuple[int, int] = (4, 2)) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``predicted`` is 1 from a score of ``PASS`` on.

    Learned from the labels outside the held-out fold. Null or empty texts are scored as texts whose statistics are
    zero. Without labels of both classes every score is 0.5. Null ids match no label; repeated labels count
    each. Statistics are made in one pass over the texts, the rest reads the narrow table.
    """
    statistics = store(statistics_table(df, id_column, text_column), "statistics")
    model = fit_quality_model(statistics, labels, fold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch["x"].flatten()).reshape(batch.num_rows, -1)
            score = model.predict(x) if model else np.full(batch.num_rows, 0.5)
            yield pa.record_batch({"doc_id": batch["doc_id"], "score": pa.array(score, pa.float64())})

    scored = statistics.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", (id_remainder("doc_id", fold[0]) == fold[1]).alias("held_out"), "score",
        (F.col("score") >= PASS).cast("int").alias("predicted"),
    )


def keep_good(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = PASS) -> DataFrame:
    """The rows of ``df``, all columns, whose score is at least ``least``; all rows if nothing can be learned."""
    model = fit_quality_model(store(statistics_table(df, id_column, text_column), "statistics"), labels)
    if model is None:
        return df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, text_column, CHUNK_BYTES):
                score = model.predict(text_statistics(chunk[text_column]))
                yield chunk.take(pa.array(np.flatnonzero(score >= least)))

    return df.mapInArrow(run, T.StructType(df.schema.fields))
