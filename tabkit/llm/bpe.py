"""Whole-text token ids of a word-end BPE vocabulary, computed once per distinct word.

Pre-tokens of this vocabulary never cross white space, so a text's ids are its words' ids in a row. Words made of ASCII
and Latin-1 letters, ASCII digits and punctuation are cut by the vocabulary's own pre-token rule and go to
the library's BPE model; every other word goes through the library's full tokenizer.
"""

from __future__ import annotations

import ctypes
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words kept by a Python worker; when more would be needed the memory is emptied and refilled.
CACHE_WORDS = 250_000
#: Text bytes that are encoded at a time.
CHUNK_BYTES = 4 << 20
#: What a row counts besides its text; bounds the rows of a slice of short texts.
ROW_BYTES = 1_024

_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ0-9!-/:-@\\[-`{-~]+").fullmatch
#: The vocabulary's pre-token rule, for lower-case text of these characters (fixed value).
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+").findall


#: A sign that is not plain, or the beginning of a special token.
_STRANGE = "[^\\t\\n\\x0b\\f\\r A-Za-zÀ-ÖØ-öø-ÿ0-9!-/:-@\\[-`{-~]|<\\|"
#: Pre-tokens of plain text other than runs of letters, in the order of ``_PIECES``.
_BETWEEN = "('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[!-/:-@\\[-`{-~]+)"


def _units(texts: pa.Array) -> pa.Array:
    """Each text as a list of strings whose ids, in a row, are the text's ids.

    Plain texts are cut into lower-case pre-tokens, of which there are far fewer than words; others into words.
    """
    strange = pc.match_substring_regex(texts, _STRANGE)
    plain = pc.replace_substring_regex(pc.utf8_lower(texts.filter(pc.invert(strange))), _BETWEEN, r" \1 ")
    lists = [pc.ascii_split_whitespace(plain), pc.ascii_split_whitespace(texts.filter(strange))]
    if not len(lists[1]):
        return lists[0]
    order = np.argsort(np.asarray(strange), kind="stable")
    return pa.concat_arrays(lists).take(pa.array(np.argsort(order, kind="stable")))


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE writes bytes as letters: printable ones as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


class WordEncoder:
    """Token ids of texts, with a bounded memory of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.model = Tokenizer(self.full.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.full.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.pool = np.empty(1 << 16, np.int32)
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _add(self, words: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        first, n = len(self.index), len(words)
        while len(self.start) < first + n:
            self.start, self.length = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.length))
        while len(self.pool) < self.used + len(ids):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.length[first : first + n] = lengths
        self.start[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.index.update(zip(words, range(first, first + n), strict=True))

    def _learn(self, words: list[str]) -> None:
        plain, other = [], []
        for w in words:
            (plain if _PLAIN(w) and "<|" not in w else other).append(w)
        if plain:
            cut = [_PIECES(w.lower()) for w in plain]
            pieces = list(dict.fromkeys(p for c in cut for p in c))
            number = dict(zip(pieces, range(len(pieces)), strict=True))
            letters = [p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in pieces]
            lines = [" ".join(letters[i : i + 50]) for i in range(0, len(letters), 50)]
            found = self.model.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.fromiter((i for e in found for i in e.ids), np.int32)
            ends = np.flatnonzero(self.closes[ids]) + 1  # the last token of a piece closes a word
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            flat = np.fromiter((number[p] for c in cut for p in c), np.int64)
            sizes = (ends - starts)[flat]
            per_word = np.add.reduceat(sizes, np.cumsum([0, *(len(c) for c in cut[:-1])])) if len(flat) else sizes
            self._add(plain, per_word, ids[_spread(starts[flat], sizes)])
        if other:
            found = [e.ids for e in self.full.encode_batch_fast(other, add_special_tokens=False)]
            flat = np.fromiter((i for x in found for i in x), np.int32)
            self._add(other, np.array([len(x) for x in found], np.int64), flat)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the offset of each text in them (one more offset than texts)."""
        words = _units(texts.fill_null(""))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.index) + len(distinct) > CACHE_WORDS:
            self._forget()
        known = self.index.get
        if new := [w for w in distinct if known(w) is None]:
            self._learn(new)
        at = np.fromiter((self.index[w] for w in distinct), np.int64, len(distinct))
        word = at[np.asarray(coded.indices)] if len(distinct) else np.empty(0, np.int64)
        sizes = self.length[word]
        until = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        offsets = np.asarray(words.offsets, np.int64)
        return self.pool[_spread(self.start[word], sizes)], until[offsets - offsets[0]]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, in a row."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


spread = _spread


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker."""
    return WordEncoder(path)


@lru_cache(maxsize=1)
def _trim():
    """glibc's way to hand freed memory back; None where there is none."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return None


def give_back() -> None:
    """Return freed memory to the system, so that idle Python workers do not hold what one batch needed."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """Slices of a batch with at most ``limit`` bytes of text, counting each row as ``ROW_BYTES`` more, or a single row."""
    sizes = np.asarray(pc.binary_length(batch[column].fill_null("")), np.int64) + ROW_BYTES
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
    give_back()


def ended(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` with ``end_id`` after each text, and the new offsets."""
    texts = len(offsets) - 1
    out = np.full(len(ids) + texts, end_id, np.int32)
    moved = offsets + np.arange(texts + 1)
    body = np.ones(len(out), bool)
    body[moved[1:] - 1] = False
    out[body] = ids
    return out, moved


def cut(offsets: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of at most ``most`` ids: the text, piece number, start in the text, and length of each."""
    lengths = np.diff(offsets)
    pieces = np.maximum(1, -(-lengths // most))
    text = np.repeat(np.arange(len(lengths)), pieces)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * most
    return text, piece, start, np.minimum(most, lengths[text] - start)
