"""Vector best-fit packing of documents into sequences under several capacities at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.bpe import cut, encoder, ended, text_chunks
from tabkit.llm.common import store

SEQUENCE = 4096
#: Pieces that one task packs; each task may leave one sequence unfilled.
GROUP_PIECES = 24_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    df: DataFrame, tokenizer: str, most: int = SEQUENCE, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Pieces of every document's ids: the whole text's ids and ``end_id``, cut after every ``most`` ids.

    ``tokenizer`` is the path of the vocabulary file, readable on every executor. Null text counts as empty
    and gives one piece that holds only ``end_id``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                ids, offsets = ended(*words.encode(chunk["text"]), end_id)
                text, piece, start, length = cut(offsets, most)
                first = offsets[text] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
                yield pa.record_batch(
                    {
                        "doc_id": chunk["doc_id"].take(pa.array(text)),
                        "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start, pa.int64()),
                        "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, _PIECES)


def best_fit(sizes: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and the number of items of that bin before it.

    ``sizes`` is (items, dimensions). Items go by decreasing weighted size; each takes, of the open bins where every
    residual capacity suffices, the one with the largest weighted dot product of item and residual (``dot``) or
    the smallest weighted norm of what would be left (``norm``); if none fits it opens a bin.
    """
    unit = sizes / capacity
    order = np.lexsort((-unit.max(axis=1), -(unit @ weights)))
    smallest = np.minimum.accumulate(unit[order][::-1], axis=0)[::-1]
    room = np.empty((1024, unit.shape[1]))
    name = np.empty(1024, np.int64)
    open_bins = made = 0
    bins, place = np.empty(len(unit), np.int64), np.empty(len(unit), np.int64)
    count: list[int] = []
    for step, i in enumerate(order):
        item = unit[i]
        if step % 512 == 0 and open_bins:  # bins that no later item fits are closed
            alive = (room[:open_bins] + 1e-12 >= smallest[step]).all(axis=1)
            kept = int(alive.sum())
            room[:kept], name[:kept] = room[:open_bins][alive], name[:open_bins][alive]
            open_bins = kept
        left = room[:open_bins] - item
        fits = np.flatnonzero((left >= -1e-12).all(axis=1))
        if len(fits):
            if rule == "dot":
                best = fits[np.argmax(room[fits] @ (weights * item))]
            else:
                best = fits[np.argmin((left[fits] ** 2) @ weights)]
            room[best] = left[best]
            b = name[best]
        else:
            if open_bins == len(room):
                room, name = np.concatenate([room, np.empty_like(room)]), np.concatenate([name, np.empty_like(name)])
            room[open_bins], name[open_bins] = 1 - item, made
            b, made, open_bins = made, made + 1, open_bins + 1
            count.append(0)
        bins[i], place[i] = b, count[b]
        count[b] += 1
    return bins, place


def pack_vectors(
    pieces: DataFrame,
    tokens: int = SEQUENCE,
    documents: int = SEQUENCE,
    attention: float = float(SEQUENCE) ** 2,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
) -> DataFrame:
    """Pack pieces into sequences that keep three capacities: tokens, documents, and attention cost.

    The attention cost of a piece is its length squared. Adds ``sequence_id`` (a number, not dense) and
    ``offset`` (place of the piece in its sequence, gapless from 0) to the columns of ``pieces``, which
    needs ``doc_id``, ``piece`` and ``length``. Raises if a piece alone exceeds a capacity.

    Pieces are dealt by a hash into groups of about ``GROUP_PIECES``, and each group is packed by one
    task. Null ids and repeated rows are packed like others; no rows give no rows.
    """
    total = pieces.count()
    groups = -(-max(1, total) // GROUP_PIECES)
    capacity = np.array([tokens, documents, attention], float)
    weigh = np.array(weights, float)
    columns = pieces.columns

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ignore_index=True, na_position="first")
        length = group["length"].to_numpy(float)
        sizes = np.column_stack([length, np.ones(len(group)), length**2])
        if (sizes > capacity).any():
            raise ValueError("a piece exceeds a capacity of the sequence")
        bins, place = best_fit(sizes, capacity, weigh, rule)
        order = np.lexsort((place, bins))
        moved = np.empty(len(group), np.int64)
        ends = np.cumsum(group["length"].to_numpy()[order])
        begins = ends - group["length"].to_numpy()[order]
        new = np.flatnonzero(np.diff(bins[order], prepend=-1))
        moved[order] = begins - np.repeat(begins[new], np.diff([*new, len(group)]))
        out = group[columns].copy()
        out["sequence_id"] = int(group["group"].iloc[0]) * 2**32 + bins
        out["offset"] = moved
        return out

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    schema = pieces.schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", sequence_id long, offset long"
    return dealt.groupBy("group").applyInPandas(pack, schema)


def pack_documents(df: DataFrame, tokenizer: str, most: int = SEQUENCE, **options) -> DataFrame:
    """Tokenize, cut and pack whole documents; see :func:`token_pieces` and :func:`pack_vectors`."""
    return pack_vectors(store(token_pieces(df, tokenizer, most), "pieces"), tokens=most, **options)
