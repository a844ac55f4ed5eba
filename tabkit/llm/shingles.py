"""Words and weighted word shingles of whole texts as arrays of 64-bit numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix64 finaliser)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(n, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """Hashes of all lower-case words in a row, the offset of each text, and a digest of each text's words.

    Words are what white space separates; a text without words has no digest.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts.fill_null("")))
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    of_name = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    indices = np.asarray(coded.indices, np.int64)
    full = np.fromiter((w != "" for w in names), bool, len(names))[indices] if names else np.empty(0, bool)
    offsets = np.asarray(lists.offsets, np.int64)
    kept = np.concatenate([[0], np.cumsum(full)])[offsets - offsets[0]]
    words = of_name[indices][full] if names else np.empty(0, np.uint64)
    raw = words.tobytes()
    digests = [
        xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) if b > a else None
        for a, b in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True)
    ]
    return words, kept, digests


def cells(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells of each text's weighted shingles, sorted within a text, and their offsets.

    The weight of a shingle of ``width`` words is how often it occurs; a shingle of weight w has w cells, one for each
    occurrence number, so the weighted Jaccard similarity of two texts is the Jaccard similarity of their sets of
    cells. A text shorter than ``width`` words is one shingle.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    texts = np.repeat(np.arange(len(lengths)), counts)
    until = np.concatenate([[0], np.cumsum(counts)])
    start = offsets[:-1][texts] + np.arange(len(texts)) - until[:-1][texts]
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    size = np.minimum(lengths[texts], width)
    value = size.astype(np.uint64)
    for j, m in enumerate(multipliers(width, 1)):
        value = value + np.where(j < size, padded[start + j], np.uint64(0)) * m
    value = mixed(value)
    order = np.lexsort((value, texts))
    value = value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (texts[1:] != texts[:-1])
    first = np.flatnonzero(fresh)
    occurrence = np.arange(len(value)) - np.repeat(first, np.diff([*first, len(value)]))
    again = occurrence > 0
    value[again] = mixed(value[again] ^ mixed(occurrence[again].astype(np.uint64)))
    return value, until


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal cells of two texts."""
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())
