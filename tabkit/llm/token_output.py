"""Packed token-id matrices: best-fit-decreasing with a segment tree over free capacities."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.bpe import cut, encoder, ended, spread, text_chunks

SEQUENCE = 4096
#: Ids packed at a time by one task; the last sequences of each such block may have padding.
BLOCK_IDS = 6_000_000

_ROW = (
    "sequence_id long, n_tokens int, n_segments int, input_ids binary, id_bytes int, cu_seqlens array<int>, "
    "position_resets array<int>, doc_ids array<long>, pieces array<int>, starts array<long>"
)


class CapacityTree:
    """Segment tree over free capacities 0..size: finds the smallest one that is at least ``need``."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def at_least(self, need: int) -> int:
        """Smallest capacity in the tree that is at least ``need``, or -1."""
        count, node = self.count, need + self.leaves
        if count[node]:
            return need
        while node > 1:  # up to the first right sibling that holds something
            if not node & 1 and count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return -1
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each length, longest first, each into the fullest bin that still takes it."""
    tree, free = CapacityTree(capacity), defaultdict(list)
    bins = np.empty(len(lengths), np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.at_least(need)
        if found < 0:
            b, found, made = made, capacity, made + 1
        else:
            b = free[found].pop()
            tree.add(found, -1)
        if found > need:
            free[found - need].append(b)
            tree.add(found - need, 1)
        bins[i] = b
    return bins


def _packed(first: int, ids: np.ndarray, doc: pa.Array, begin, piece, start, length, most: int, pad: int, dtype) -> pa.RecordBatch:
    bins = best_fit_decreasing(length, most)
    order = np.lexsort((-length, bins))
    length, begin, piece, start, bins = (a[order] for a in (length, begin, piece, start, bins))
    segments = np.bincount(bins)
    rows = len(segments)
    head = np.concatenate([[0], np.cumsum(segments)])
    ends = np.cumsum(length)
    filled = np.add.reduceat(length, head[:-1])
    base = np.repeat(np.cumsum(filled) - filled, segments)
    resets = ends - length - base
    matrix = np.full((rows, most), pad, dtype)
    where = np.repeat(bins * most + resets, length) + (np.arange(int(ends[-1])) - np.repeat(ends - length, length))
    matrix.reshape(-1)[where] = ids[spread(begin, length)]
    raw = matrix.tobytes()
    width = most * matrix.itemsize
    lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(head, pa.int32()), pa.array(values, kind))
    # cumulative lengths: one more entry than segments, starting at 0
    cu_offsets = head + np.arange(rows + 1)
    cu = np.zeros(int(cu_offsets[-1]), np.int64)
    inner = np.ones(len(cu), bool)
    inner[cu_offsets[:-1]] = False
    cu[inner] = resets + length
    return pa.record_batch(
        {
            "sequence_id": pa.array(first + np.arange(rows), pa.int64()),
            "n_tokens": pa.array(filled, pa.int32()),
            "n_segments": pa.array(segments, pa.int32()),
            "input_ids": pa.array([raw[i * width : (i + 1) * width] for i in range(rows)], pa.binary()),
            "id_bytes": pa.array(np.full(rows, matrix.itemsize), pa.int32()),
            "cu_seqlens": pa.ListArray.from_arrays(pa.array(cu_offsets, pa.int32()), pa.array(cu, pa.int32())),
            "position_resets": lists(resets, pa.int32()),
            "doc_ids": pa.ListArray.from_arrays(pa.array(head, pa.int32()), doc.take(pa.array(order))),
            "pieces": lists(piece, pa.int32()),
            "starts": lists(start, pa.int64()),
        }
    )


def packed_matrices(
    df: DataFrame,
    tokenizer: str,
    most: int = SEQUENCE,
    end_id: int = 1,
    pad_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per packed sequence of ``most`` ids, padded with ``pad_id``.

    A document is its whole text's ids and ``end_id``; only longer ones are cut, without loss, into pieces
    of ``most`` ids. ``input_ids`` are little-endian unsigned integers of ``id_bytes`` bytes (2 if the
    vocabulary allows). ``cu_seqlens`` are cumulative segment lengths from 0, ``position_resets`` the places where
    positions start again at 0, and ``doc_ids``, ``pieces``, ``starts`` say what each segment is.

    Every task packs blocks of about ``BLOCK_IDS`` ids of its own input, so ids are never shuffled; a block may leave its
    last sequences unfilled. ``sequence_id`` combines the partition and a count. Null text counts as empty (one
    segment with ``end_id``); null ids stay null; repeated rows are all packed; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        dtype = np.dtype("<u2" if max(words.size, pad_id + 1, end_id + 1) <= 1 << 16 else "<u4")
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        held: list[tuple] = []
        size = made = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, made
            shift = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
            begin = np.concatenate([h[2] + s for h, s in zip(held, shift, strict=True)])
            docs = pa.concat_arrays([h[1] for h in held])
            piece, start, length = (np.concatenate([h[k] for h in held]) for k in (3, 4, 5))
            out = _packed(number + made, np.concatenate([h[0] for h in held]), docs, begin, piece, start, length, most, pad_id, dtype)
            made += out.num_rows
            held, size = [], 0
            return out

        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                ids, offsets = ended(*words.encode(chunk["text"]), end_id)
                text, piece, start, length = cut(offsets, most)
                held.append((ids.astype(dtype), chunk["doc_id"].take(pa.array(text)), offsets[text] + start, piece, start, length))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, _ROW)


def position_ids(resets: Column, n_tokens: Column) -> Column:
    """Position of every token in its segment, from ``position_resets`` and ``n_tokens``."""
    every = F.sequence(F.lit(0), n_tokens - 1)
    return F.transform(every, lambda i: i - F.array_max(F.filter(resets, lambda r: r <= i)))
