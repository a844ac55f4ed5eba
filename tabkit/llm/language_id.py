"""Language identification in two steps: the family first, then pairs of languages within it."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.bpe import text_chunks
from tabkit.llm.common import id_remainder

#: Families of common languages; a language that is not listed is a family of its own. Fixed values.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "bg", "sr", "hr", "sl", "cs", "sk", "pl", "mk"),
}
#: Bound of the sample of labelled rows that the classifiers are fitted on, over all languages.
SAMPLE_ROWS = 4_000
#: Hashed character n-grams (1 to 3 letters) per document.
FEATURES = 2_048
UNKNOWN = "und"
CHUNK_BYTES = 2 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for every code point that is a letter; built once per worker."""
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)


def features(texts: pa.Array, size: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of n-gram shares of each whole text (unit length), and its number of letters.

    Text is lower-cased and everything but letters is a word boundary; n-grams include boundaries.
    """
    lower = pc.utf8_lower(texts.fill_null(""))
    lengths = np.asarray(pc.utf8_length(lower), np.int64) + 2
    joined = "".join(f" {t} " for t in lower.to_pylist())
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    code = np.where(letter, code, np.uint32(32)).astype(np.uint32)
    row = np.repeat(np.arange(len(lengths)) * size, lengths)
    ends = np.cumsum(lengths)
    counts = np.bincount(row[letter] + (code[letter] * np.uint32(2654435761) >> np.uint32(21)) % size, minlength=len(lengths) * size).astype(np.float32)
    inside = np.ones(len(code), bool)
    inside[ends - 1] = False
    two = code[:-1] * np.uint32(0x9E3779B1) + code[1:] * np.uint32(0x85EBCA77)
    keep = inside[:-1] & (letter[:-1] | letter[1:])
    counts += np.bincount(row[:-1][keep] + ((two[keep] ^ two[keep] >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(12)) % size, minlength=len(counts))
    three = two[:-1] * np.uint32(0xC2B2AE3D) + code[2:] * np.uint32(0x27D4EB2F)
    keep = inside[:-2] & inside[1:-1] & letter[1:-1]
    counts += np.bincount(row[:-2][keep] + ((three[keep] ^ three[keep] >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(12)) % size, minlength=len(counts))
    counts = counts.reshape(-1, size)
    total = counts.sum(axis=1, keepdims=True)
    n_letters = np.add.reduceat(letter.astype(np.int64), ends - lengths) if len(lengths) else np.empty(0, np.int64)
    return np.sqrt(counts / np.maximum(total, 1)), n_letters


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 20.0, steps: int = 80) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by accelerated gradient; ``y`` is -1 or 1, classes have equal weight."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    ahead_w, ahead_b = w, b
    rate = 1 / (1 + 4 * cost)  # rows have unit length
    for t in range(1, steps + 1):
        slack = np.maximum(0, 1 - y * (x @ ahead_w + ahead_b)) * weight * y
        new_w = ahead_w - rate * (ahead_w - 2 * cost * (slack @ x))
        new_b = ahead_b + rate * 2 * cost * slack.sum()
        pace = (t - 1) / (t + 2)
        ahead_w, ahead_b = new_w + pace * (new_w - w), new_b + pace * (new_b - b)
        w, b = new_w, new_b
    return w, b


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve over margins (Newton steps, smoothed targets)."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        s = p * (1 - p)
        hessian = np.array([[(s * margin**2).sum(), (s * margin).sum()], [(s * margin).sum(), s.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, [((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        a, b = a - step[0], b - step[1]
    return max(a, 0.0), b


@dataclass
class Profile:
    """What texts of the learned languages look like: log shares of n-grams in their even mixture, and what texts reach on average.

    The mixture lets texts of several learned languages through.
    """

    log_share: np.ndarray
    centre: float  # of the language whose texts reach least
    spread: float  # variance between texts of a language
    scatter: float  # variance of a single n-gram

    @classmethod
    def fit(cls, x: np.ndarray, lang: np.ndarray) -> Profile:
        """Each row is judged by the others, so a language of few rows gives a wide profile."""
        codes, prior = sorted(set(lang.tolist())), 1 / x.shape[1]
        rows = {c: np.flatnonzero(lang == c) for c in codes}
        totals = {c: sum((x[i].astype(np.float64) ** 2 for i in rows[c]), np.zeros(x.shape[1])) for c in codes}
        share = sum((totals[c] + prior) / (len(rows[c]) + 1) for c in codes) / len(codes)
        centres, spreads = [], []
        for c in codes:
            n, rest = len(rows[c]), share - (totals[c] + prior) / (len(rows[c]) + 1) / len(codes)
            own = (x[i].astype(np.float64) ** 2 for i in rows[c])
            reached = np.array([r @ np.log(rest + (np.maximum(totals[c] - r, 0) + prior) / n / len(codes)) for r in own])
            centres.append(float(np.median(reached)))
            spreads.append((1.4826 * float(np.median(np.abs(reached - centres[-1])))) ** 2)
        log = np.log(share)
        return cls(log, min(centres), max(spreads), float(share @ log**2 - (share @ log) ** 2))


@dataclass
class LanguageModel:
    """Weights of all linear classifiers in one matrix: families first, then pairs of languages."""

    families: list[list[str]]
    pairs: list[tuple[int, int, int]]  # family, first and second language in it
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray
    shift: np.ndarray
    profile: Profile

    @classmethod
    def fit(cls, x: np.ndarray, lang: np.ndarray, families: dict[str, tuple[str, ...]]) -> LanguageModel:
        home = {code: name for name, codes in families.items() for code in codes}
        groups: dict[str, list[str]] = {}
        for code in sorted(set(lang.tolist())):
            groups.setdefault(home.get(code, code), []).append(code)
        names = sorted(groups)
        sets = [groups[n] for n in names]
        held = np.arange(len(lang)) % 5 == 4  # rows that calibrate the margins
        found: list[tuple[np.ndarray, float, float, float]] = []

        def one(rows: np.ndarray, y: np.ndarray) -> None:
            fit, check = ~held[rows], held[rows]
            if len(set(y[fit])) < 2:
                fit = np.ones(len(y), bool)
            if len(set(y[check])) < 2:
                check = np.ones(len(y), bool)
            w, b = linear_svm(x[rows][fit], y[fit])
            found.append((w, b, *calibrate(x[rows][check] @ w + b, y[check])))

        if len(sets) > 1:
            for members in sets:
                one(np.arange(len(lang)), np.where(np.isin(lang, members), 1.0, -1.0))
        pairs = []
        for f, members in enumerate(sets):
            for i, j in combinations(range(len(members)), 2):
                pairs.append((f, i, j))
                rows = np.flatnonzero(np.isin(lang, [members[i], members[j]]))
                one(rows, np.where(lang[rows] == members[i], 1.0, -1.0))
        w = np.array([f[0] for f in found]).reshape(-1, x.shape[1])
        b, slope, shift = (np.array([f[k] for f in found]) for k in (1, 2, 3))
        return cls(sets, pairs, w.astype(np.float32), b, slope, shift, Profile.fit(x, lang))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and probability of each row: the best family, then votes of its pairs."""
        n = len(x)
        p = 1 / (1 + np.exp(-np.clip((x @ self.weights.T + self.bias) * self.slope + self.shift, -30, 30)))
        several = len(self.families) > 1
        first = len(self.families) if several else 0
        family_p = p[:, :first] / p[:, :first].sum(axis=1, keepdims=True) if several else np.ones((n, 1))
        family = family_p.argmax(axis=1)
        lang = np.empty(n, object)
        score = family_p.max(axis=1)
        for f, members in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            votes, belief = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for k, (g, i, j) in enumerate(self.pairs):
                if g == f:
                    q = p[rows, first + k]
                    votes[:, i] += q >= 0.5
                    votes[:, j] += q < 0.5
                    belief[:, i] += q
                    belief[:, j] += 1 - q
            best = (votes + belief / (len(members) + 1)).argmax(axis=1)
            lang[rows] = np.array(members, object)[best]
            if len(members) > 1:
                score[rows] *= belief[np.arange(len(rows)), best] / (len(members) - 1)
        return lang, np.clip(score, 0.0, 1.0)

    def likeness(self, x: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """How far each row's n-grams are from the learned languages, in standard deviations; far is negative.

        The scores of ``predict`` share one between the learned languages, so they say nothing of texts of no learned language; this
        does. Few different n-grams give a wide deviation, so short texts are not far.
        """
        share, p = x.astype(np.float64) ** 2, self.profile
        different = np.minimum(np.maximum(letters, 1), 1 / np.maximum((share**2).sum(axis=1), 1e-9))
        return (share @ p.log_share - p.centre) / np.sqrt(p.spread + p.scatter / different)


def fit_language_model(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    fold: tuple[int, int] = (3, 1),
    sample_rows: int = SAMPLE_ROWS,
    families: dict[str, tuple[str, ...]] | None = None,
) -> LanguageModel | None:
    """Fit on a sample of about ``sample_rows`` labelled rows, equally many of each language where there are as many.

    Rows whose id's CRC-32 modulo ``fold[0]`` is ``fold[1]`` are never used. None if no row has text and language. The
    sample is a hash threshold for each language, so it does not depend on partitions.
    """
    labelled = df.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull() & (id_remainder(id_column, fold[0]) != fold[1]))
    sizes = labelled.groupBy(F.col(lang_column).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(sample_rows).collect()
    if not sizes:
        return None
    each = max(1, sample_rows // len(sizes))
    draw = F.pmod(F.xxhash64(F.col(id_column), F.col(text_column), F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*[v for r in sizes for v in (F.lit(r["lang"]), F.lit(each / r["count"]))])
    chosen = labelled.where(draw < share[F.col(lang_column)]).select(
        F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), draw.alias("draw")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", CHUNK_BYTES):
                x, letters = features(chunk["text"])
                kept = np.flatnonzero(letters)
                yield pa.record_batch(
                    {
                        "lang": chunk["lang"].take(pa.array(kept)),
                        "draw": chunk["draw"].take(pa.array(kept)),
                        "x": pa.array([x[i].astype(np.float16).tobytes() for i in kept], pa.binary()),
                    }
                )

    rows = sorted(chosen.mapInArrow(run, "lang string, draw double, x binary").collect(), key=lambda r: (r["draw"], r["x"]))
    if not rows:
        return None
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float16).reshape(len(rows), -1).astype(np.float32)
    return LanguageModel.fit(x, np.array([r["lang"] for r in rows], object), families or FAMILIES)


def identify_languages(
    df: DataFrame,
    model: LanguageModel | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float | None = None,
    far: float | None = None,
) -> DataFrame:
    """``lang_pred`` and ``score`` for every whole text, beside all columns of ``df``.

    A text that is null or has no letter, or any text if there is no model, is ``und`` with score 0. With ``least``, rows that are
    ``und`` or score below it are dropped, and the columns of ``df`` are returned alone. With ``far`` besides, rows go whose n-grams are
    more than so many standard deviations less likely than those of texts of the learned languages.
    """
    names = df.columns
    if least is None:
        schema = T.StructType([*(f for f in df.schema if f.name not in ("lang_pred", "score")), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    else:
        schema = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, text_column, CHUNK_BYTES):
                x, letters = features(chunk[text_column])
                lang, score = model.predict(x) if model else (np.full(len(letters), UNKNOWN, object), np.zeros(len(letters)))
                lang[letters == 0] = UNKNOWN
                score[letters == 0] = 0.0
                if least is not None:
                    good = (lang != UNKNOWN) & (score >= least)
                    if model and far is not None:
                        good &= model.likeness(x, letters) >= -far
                    yield chunk.take(pa.array(np.flatnonzero(good)))
                    continue
                own = {n: chunk[n] for n in names if n not in ("lang_pred", "score")}
                yield pa.record_batch(own | {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())})

    return df.mapInArrow(run, schema)


def language_predictions(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", fold: tuple[int, int] = (3, 1)) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; learned from the other folds of the same rows.

    ``held_out`` marks the rows that nothing was learned from. Null ids are in no held-out fold; repeated
    rows are all predicted; languages, sources and ids are never inputs of a prediction.
    """
    model = fit_language_model(df, id_column, text_column, lang_column, fold)
    rows = df.select(
        F.col(id_column).alias("doc_id"),
        (id_remainder(id_column, fold[0]) == fold[1]).alias("held_out"),
        F.col(text_column).cast("string").alias("text"),
    )
    return identify_languages(rows, model).select("doc_id", "held_out", "lang_pred", "score")
