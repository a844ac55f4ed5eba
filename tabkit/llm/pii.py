"""Personal data in texts: checked patterns, and a semi-Markov conditional random field that scores whole spans."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.bpe import text_chunks

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Pieces of the longest span: nineteen digits with a separator after each.
MOST_PIECES = 40
#: Rows (expected), shapes and pieces of a shape that the field is fitted on.
SAMPLE_ROWS, SAMPLE_SHAPES, SAMPLE_PIECES = 20_000, 1_500, 64
ROUNDS, RATE, PENALTY = 40, 0.3, 0.02

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_CALL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_HINT = re.compile(r"[0-9@]")
#: Words with a digit or @, with single spaces between them.
_ISLAND = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*(?: [^\s0-9@]*+[0-9@]\S*)*")
_PIECE = re.compile(r"9+|a+|¤+|.", re.DOTALL)
_TO_SHAPE = str.maketrans("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "9" * 10 + "a" * 52)
_FOREIGN = re.compile(r"[^\x00-\x7f]")

Span = tuple[int, int, int]  # start, end, kind


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pattern_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the four patterns that pass their checks, and those that fail; leftmost, non-overlapping per kind.

    Every pattern takes time in proportion to the text: an address is sought around each ``@``, and runs of digits are
    taken whole.
    """
    good: list[Span] = []
    bad: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            good.append((start, free, EMAIL))
        at = text.find("@", max(at + 1, free))
    for m in _QUAD.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        fits = all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
        (good if fits else bad).append((m.start(), m.end(), IP))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() < 14:
            continue
        digits = _NO_DIGIT.sub("", m.group())
        (good if 14 <= len(digits) <= 19 and _luhn(digits) else bad).append((m.start(), m.end(), CARD))
    for m in _CALL.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        (good if 10 <= len(digits) <= 15 else bad).append((m.start(), m.end(), PHONE))
    good.sort(key=lambda s: (s[0], s[2]))
    return good, bad


def shape_of(text: str) -> str:
    """Digits become 9, letters a, other non-ASCII characters one sign; offsets stay."""
    return _FOREIGN.sub("¤", text.translate(_TO_SHAPE))


def open_parts(text: str, taken: list[Span]) -> Iterator[tuple[int, str, str, str]]:
    """``start, left, shape, right`` of the stretches that may hold more spans: a digit or @ outside of ``taken``."""
    spans = sorted((a, b) for a, b, _ in taken)
    at = 0
    for island in _ISLAND.finditer(text):
        start, end = island.span()
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        cursor, k, parts = start, at, []
        while k < len(spans) and spans[k][0] < end:
            if spans[k][0] > cursor:
                parts.append((cursor, spans[k][0]))
            cursor = max(cursor, spans[k][1])
            k += 1
        if cursor < end:
            parts.append((cursor, end))
        for a, b in parts:
            if _HINT.search(text, a, b):
                yield a, " ", shape_of(text[a:b]), " "


#: Names and sizes of the feature groups of a segment; each group has one active feature.
_GROUPS = {
    "bias": 1, "digits": 22, "runs": 10, "letters": 8, "ats": 3, "dots": 6, "domain": 6, "spaces": 7, "hyphens": 6, "brackets": 3,
    "others": 4, "first": 5, "last": 3, "left": 8, "right": 8, "plus": 3, "longest": 22, "even": 4, "called": 44, "plain": 44, "quad": 2,
}
_START = dict(zip(_GROUPS, np.cumsum([0, *_GROUPS.values()]).tolist(), strict=False))
FEATURES = sum(_GROUPS.values())
_SIGNS = {c: i for i, c in enumerate("9a¤@. -()+")}
_NEAR = {"9": 0, "a": 1, "¤": 1, " ": 2, "": 2, ".": 3, "-": 4, "+": 5, "@": 6}


def _running(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags)])


def segments(left: str, shape: str, right: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Piece borders of a shape, and first piece, end piece and active features of every segment that could be a span.

    A span has at most ``MOST_PIECES`` pieces (runs of digits, of letters, of other signs), holds a digit or @, begins with a
    digit, letter, plus or bracket, and ends with a digit or letter.
    """
    runs = [m.span() for m in _PIECE.finditer(shape)]
    borders = np.array([0, *(b for _, b in runs)], np.int64)
    sign = np.array([_SIGNS.get(shape[a], 10) for a, _ in runs], np.int64)
    size = np.diff(borders)
    n = len(runs)
    starts = np.flatnonzero(np.isin(sign, (0, 1, 7, 9)))
    i, span = np.repeat(starts, MOST_PIECES), np.tile(np.arange(1, MOST_PIECES + 1), len(starts))
    j = i + span
    ok = j <= n
    ok[ok] = sign[j[ok] - 1] <= 1
    hints = _running((sign == 0) | (sign == 3))
    ok[ok] = hints[j[ok]] > hints[i[ok]]
    i, j = i[ok], j[ok]
    count = lambda flags: (lambda r: r[j] - r[i])(_running(flags))
    digits = np.minimum(count(np.where(sign == 0, size, 0)), 21)
    groups, dots, spaces, hyphens = (count(sign == s) for s in (0, 4, 5, 6))
    ats, pluses, others = count(sign == 3), count(sign == 9), count((sign == 10) | (sign == 2))
    opened, closed = count(sign == 7), count(sign == 8)
    letters = count(sign == 1)
    last_at = np.maximum.accumulate(np.where(sign == 3, np.arange(n), -1))[j - 1] if n else j
    all_dots = _running(sign == 4)
    domain = np.where(last_at >= i, np.minimum(all_dots[j] - all_dots[np.maximum(last_at, 0)], 4), 5)
    padded = np.concatenate([np.where(sign == 0, size, 0), np.zeros(MOST_PIECES, np.int64)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, MOST_PIECES)
    longest = np.maximum.accumulate(windows, axis=1)[i, j - i - 1]
    shortest = np.minimum.accumulate(np.where(windows > 0, windows, 1 << 30), axis=1)[i, j - i - 1]
    even = np.where(groups <= 1, 0, np.where(longest == shortest, np.where(longest == 4, 1, 2), 3))
    before = np.array([_NEAR.get(left, 7), *(_NEAR.get(shape[b - 1], 7) for _, b in runs)])[i]
    after = np.array([*(_NEAR.get(shape[a], 7) for a, _ in runs), _NEAR.get(right, 7)])[j]
    first = np.select([sign[i] == 0, sign[i] == 1, sign[i] == 9, sign[i] == 7], [0, 1, 2, 3], 4)
    only = (letters + ats + dots + others + pluses + opened + closed) == 0
    quad = (groups == 4) & (dots == 3) & (j - i == 7) & (longest <= 3)
    values = {
        "bias": np.zeros(len(i), np.int64), "digits": digits, "runs": np.minimum(groups, 9), "letters": np.minimum(letters, 7),
        "ats": np.minimum(ats, 2), "dots": np.minimum(dots, 5), "domain": domain, "spaces": np.minimum(spaces, 6),
        "hyphens": np.minimum(hyphens, 5), "brackets": np.where(opened + closed == 0, 0, np.where((opened == 1) & (closed == 1), 1, 2)),
        "others": np.minimum(others, 3), "first": first, "last": np.where(sign[j - 1] == 0, 0, 1), "left": before, "right": after,
        "plus": np.minimum(pluses, 2), "longest": np.minimum(longest, 21), "even": even, "called": digits + 22 * (first == 2),
        "plain": digits + 22 * only, "quad": quad.astype(np.int64),
    }
    return borders, i, j, np.column_stack([values[g] + _START[g] for g in _GROUPS]).astype(np.int32)


@dataclass(frozen=True)
class SpanField:
    """Weights of every feature for every kind; a piece outside of all spans scores 0."""

    weights: np.ndarray

    def best(self, left: str, shape: str, right: str) -> list[Span]:
        """The segmentation of highest score: Viterbi over segments of bounded length, boundaries and kinds together."""
        borders, i, j, features = segments(left, shape, right)
        if not len(i):
            return []
        score = self.weights[features].sum(axis=1)
        kind = score.argmax(axis=1)
        top = score[np.arange(len(i)), kind]
        use = np.flatnonzero(top > 0)  # others are never better than leaving their pieces out
        use = use[np.argsort(j[use], kind="stable")]
        best, back = [0.0] * len(borders), [-1] * len(borders)
        at = 0
        for end in range(1, len(borders)):
            best[end] = best[end - 1]
            while at < len(use) and j[use[at]] == end:
                s = use[at]
                if best[i[s]] + top[s] > best[end] + 1e-9:
                    best[end], back[end] = best[i[s]] + float(top[s]), int(s)
                at += 1
        spans, end = [], len(borders) - 1
        while end > 0:
            s = back[end]
            if s < 0:
                end -= 1
            else:
                spans.append((int(borders[i[s]]), int(borders[j[s]]), int(kind[s])))
                end = int(i[s])
        return spans[::-1]


def _example(marked: str) -> tuple[str, list[Span]]:
    """A shape and its spans from a template such as ``<phone:+9 999 999 9999>,``."""
    shape, spans, at = "", [], 0
    for m in re.finditer(r"<(\w+):([^>]*)>", marked):
        shape += marked[at : m.start()]
        spans.append((len(shape), len(shape) + len(m[2]), KINDS.index(m[1])))
        shape += m[2]
        at = m.end()
    return shape + marked[at:], spans


def _templates() -> list[tuple[str, list[Span]]]:
    """Common spellings of personal data and of other numbers, for corpora that hold few."""
    cards = ["9" * n for n in range(14, 20)] + [s.join(["9999"] * 4) for s in " -"] + ["9999 999999 99999", "9999-999999-9999"]
    phones = ["+9 (999) 999-9999", "+9 999 999 9999", "+99 99 9999 9999", "+99 999 9999999", "+9-999-999-9999", "+999999999999", "+99 (9) 9999 999999", "+9.999.999.9999"]
    quads = [".".join("9" * n for n in x) for x in ((3, 3, 3, 3), (2, 3, 1, 2), (1, 1, 1, 1), (3, 2, 2, 3), (3, 1, 3, 1), (2, 2, 3, 3))]
    mails = ["aaaa@aaaaa.aaa", "aaaaa.99@aaaa9.aaaaaaa.aaa", "aa_aa@aaaa.aa.aa", "aaa+aaa@aaaaaa.aa", "a.aaaa@aaa-aaa.aaa", "aaaa99@aaaaa.aa"]
    whole = [f"<{k}:{s}>" for k, many in (("card", cards), ("phone", phones), ("ip", quads), ("email", mails)) for s in many]
    ends = ["", ",", ".", "!!", '"', "###", "¤", ")"]
    made = [w + e for w in whole for e in ends] + [f'({w})' for w in whole] + [f"a:{w}" for w in whole]
    made += [f"{a} {b}" for a in whole[:12] for b in whole[:12]] + [f"{a} {b}" for a in whole[6:24:3] for b in whole[6:24:3]]
    plain = [
        "9", "99", "999", "9999", "99999", "999999", "9999999", "99999999", "999999999", "9999999999", "99999999999", "9999-99-99", "99/99/9999", "99.99.9999",
        "99:99", "99:99:99", "9,999.99", "$99.99", "99%", "9.9", "9.9.9", "99.99", "999-9999", "99-99", "9999-9999", "9999 9999", "99 99 99", "a9a99a9a9a99a9", "9a9a9a9a9999a9a99a9a9a9",
        "a=9", "a99", "9a", "#99", "(9)", "[99]", "@aaaa", "aa@aa", "a@", "999a9999a9aa99999a9a", "9.9.9-aa9", "9+9", "9x9", "+9", "+99", "9" * 24, "9" * 32, "aaaa-9999-aaaa", "99.9.9aa",
    ]
    hexes = [shape_of(hashlib.sha1(str(k).encode()).hexdigest()[: 40 - 8 * (k % 3)]) for k in range(60)]
    return [_example(m) for m in made] + [(p + e, []) for p in plain for e in ends] + [(q + h + q, []) for h in hexes for q in ("", '"')]


def _fit(examples: list[tuple[str, list[Span], float]], rounds: int, rate: float, penalty: float) -> np.ndarray:
    """Maximise the conditional likelihood of all segmentations by exact forward and backward sums."""
    text, first, end, gold, found, pieces = [], [], [], [], [], []
    for b, (shape, spans, _) in enumerate(examples):
        borders, i, j, features = segments(" ", shape, " ")
        named = {(a, z): k for a, z, k in spans}
        text.append(np.full(len(i), b))
        first.append(i)
        end.append(j)
        gold.append(np.array([named.get((int(borders[x]), int(borders[y])), -1) for x, y in zip(i, j, strict=True)], np.int64))
        found.append(features)
        pieces.append(len(borders) - 1)
    b, i, j, y = (np.concatenate(x).astype(np.int64) for x in (text, first, end, gold))
    features, pieces = np.concatenate(found), np.array(pieces)
    share = np.array([w for _, _, w in examples])
    share = share / share.sum() * len(share)
    most = int(pieces.max(initial=0))
    by_end, by_first = ([np.flatnonzero(x == k) for k in range(most + 1)] for x in (j, i))
    target = np.zeros((len(b), len(KINDS)))
    target[y >= 0, y[y >= 0]] = 1
    w, mean, square = np.zeros((FEATURES, len(KINDS))), 0.0, 0.0
    w[_START["bias"]] = -4.0
    flat = features.ravel()
    for step in range(1, rounds + 1):
        odds = np.exp(np.clip(w[features].sum(axis=1), -40, 40))
        total = odds.sum(axis=1)
        ahead, behind = np.zeros((len(examples), most + 1)), np.zeros((len(examples), most + 2))
        ahead[:, 0] = 1
        for k in range(1, most + 1):
            s = by_end[k]
            ahead[:, k] = ahead[:, k - 1] + np.bincount(b[s], ahead[b[s], i[s]] * total[s], len(examples))
        behind[np.arange(len(examples)), pieces] = 1
        for k in range(most - 1, -1, -1):
            s = by_first[k]
            behind[:, k] += behind[:, k + 1] * (pieces > k) + np.bincount(b[s], total[s] * behind[b[s], j[s]], len(examples))
        chance = (ahead[b, i] * behind[b, j] / behind[b, 0])[:, None] * odds
        miss = (target - chance) * share[b][:, None] / len(examples)
        slope = np.column_stack([np.bincount(flat, np.repeat(miss[:, k], features.shape[1]), FEATURES) for k in range(len(KINDS))])
        slope -= penalty / len(examples) * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        w = w + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w


def _shapes(df: DataFrame) -> DataFrame:
    """``shape, spans`` of the islands of all texts whose pattern spans are beyond doubt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                shapes, named = [], []
                for text in chunk["text"].to_pylist():
                    text = text or ""
                    good, bad = pattern_spans(text)
                    spans = sorted(good + bad)
                    failed = set(bad)
                    for island in _ISLAND.finditer(text):
                        a, z = island.span()
                        if z - a > 4 * SAMPLE_PIECES:
                            continue
                        inside = [s for s in spans if s[0] < z and s[1] > a]
                        apart = all(x[1] <= y[0] for x, y in zip(inside, inside[1:], strict=False))
                        if apart and all(s[0] >= a and s[1] <= z and s not in failed for s in inside):
                            shapes.append(shape_of(text[a:z]))
                            named.append(",".join(f"{s - a}:{e - a}:{k}" for s, e, k in inside))
                yield pa.record_batch({"shape": pa.array(shapes, pa.string()), "spans": pa.array(named, pa.string())})

    return df.mapInArrow(run, "shape string, spans string")


def fit_span_field(
    docs: DataFrame,
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    sample_shapes: int = SAMPLE_SHAPES,
    rounds: int = ROUNDS,
    rate: float = RATE,
    penalty: float = PENALTY,
) -> SpanField:
    """Learn from spans that pass the patterns' checks in about ``sample_rows`` rows, drawn by a hash of the text.

    Digits and letters count only by their number, so the field learns what a span looks like and can find one that a check
    rejects. Stretches with a rejected or overlapping match are left out as doubtful. Of the distinct shapes at most
    ``sample_shapes``, drawn by their hash, are fitted, beside fixed templates. An empty table leaves the templates.
    """
    texts = docs.select(F.col(text_column).cast("string").alias("text")).where("text IS NOT NULL")
    rows = max(1, texts.count())
    drawn = texts.where(F.pmod(F.xxhash64("text"), F.lit(2**31)) < int(min(1.0, sample_rows / rows) * 2**31))
    counted = _shapes(drawn).groupBy("shape", "spans").agg(F.count("*").alias("n")).orderBy(F.xxhash64("shape", "spans")).limit(sample_shapes)
    examples = [(shape, spans, 1.0) for shape, spans in _templates()]
    for row in counted.collect():
        if len(_PIECE.findall(row["shape"])) <= SAMPLE_PIECES:
            spans = [tuple(int(x) for x in s.split(":")) for s in row["spans"].split(",") if s]
            examples.append((row["shape"], spans, 1.0 + float(np.log(row["n"]))))
    return SpanField(_fit(examples, rounds, rate, penalty).astype(np.float64))


def document_spans(text: str, best) -> list[tuple[int, int, int, bool]]:
    """All spans of a text in order of start and kind: ``start, end, kind, whether the field added it``."""
    good, _ = pattern_spans(text)
    found = [(*s, False) for s in good]
    for at, left, shape, right in open_parts(text, good):
        found += [(at + a, at + z, k, True) for a, z, k in best(left, shape, right)]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def personal_spans(df: DataFrame, field: SpanField, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row; a span has kind, start, end (code points, end exclusive), its text, and ``learned``.

    Spans of the four patterns that pass their checks are always there. Between them the field decides jointly which
    stretches are spans, where they begin and end, and of which kind; these are marked ``learned``. Null and empty texts have
    none; rows are independent, so null or repeated ids change nothing.
    """
    weights = field.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SpanField(weights)
        known = lru_cache(maxsize=50_000)(own.best)
        best = lambda left, shape, right: (known if len(shape) <= 256 else own.best)(left, shape, right)
        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                texts = [t or "" for t in chunk["text"].to_pylist()]
                each = [document_spans(t, best) for t in texts]
                flat = [(s, t) for spans, t in zip(each, texts, strict=True) for s in spans]
                struct = pa.StructArray.from_arrays(
                    [
                        pa.array([KINDS[s[2]] for s, _ in flat], pa.string()),
                        pa.array([s[0] for s, _ in flat], pa.int64()),
                        pa.array([s[1] for s, _ in flat], pa.int64()),
                        pa.array([t[s[0] : s[1]] for s, t in flat], pa.string()),
                        pa.array([s[3] for s, _ in flat], pa.bool_()),
                    ],
                    ["kind", "start", "end", "text", "learned"],
                )
                offsets = pa.array(np.cumsum([0, *(len(s) for s in each)]), pa.int32())
                yield pa.record_batch({"doc_id": chunk["doc_id"], "spans": pa.ListArray.from_arrays(offsets, struct)})

    rows = df.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,text:string,learned:boolean>>")


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the pattern spans of each row of :func:`personal_spans`, and all its spans as text."""
    base = F.filter("spans", lambda s: ~s["learned"])
    of_kind = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans")
    )


def masked(df: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` with every span in the text replaced by its kind in brackets; overlapping spans give one mark.

    ``found`` is the result of :func:`personal_spans` for ``df``; ids must be unique and not null. Rows without spans stay as they are.
    """
    merged = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(
            F.struct(
                F.concat(acc["done"], F.substring(F.col("_text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("done"),
                s["end"].alias("at"),
            )
        ),
    )
    spans = found.select(F.col("doc_id").alias("_id"), "spans")
    joined = df.withColumn("_text", F.col(text_column)).join(spans, F.col(id_column) == F.col("_id"), "left").withColumn("_m", merged)
    text = F.concat(F.col("_m.done"), F.expr("substring(_text, _m.at + 1)"))
    return joined.withColumn(text_column, F.when(F.size("spans") > 0, text).otherwise(F.col("_text"))).select(df.columns)
