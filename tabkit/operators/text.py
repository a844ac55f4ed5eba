"""Text classification: tokens, stems, vocabulary, bags of words, language gate, intents, routing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tabkit.errors import ModelTrainingError
from tabkit.functions.columns import require_columns
from tabkit.functions.porter import stem
from tabkit.functions.scalars import tokens
from tabkit.operators.network import bags, chances, fit_network, weights_of
from tabkit.plans.ordered import dense_codes
from tabkit.plans.sizing import spread

MIN_LANGUAGE_CHARS = 20
LANGUAGE_CONFIDENCE = 0.7
#: Bytes of texts whose trigrams are hashed at a time, and languages whose sums a task holds at a time.
GRAM_BYTES, HELD_LANGUAGES = 1 << 18, 256
#: Bytes of texts whose characters are counted at a time.
COUNTED_BYTES = 1 << 20
INTENT_CONFIDENCE = 0.75
FALLBACK = "Sorry, I did not understand the question."
ENGLISH_ONLY = "This service answers messages in English."
FAILED = "Something went wrong, please try again."


def tokenize(df: DataFrame, text: str, column: str = "tokens") -> DataFrame:
    require_columns(df, [text])
    return df.withColumn(column, tokens(F.col(text)))


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """Every distinct token with the number of its occurrences: (token, n)."""
    exploded = spread(df.select(text)).select(F.explode(tokens(F.col(text))).alias("token"))
    return exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def character_counts(text: Column, characters: str) -> Column:
    """How often each of some characters occurs in a text, as an array; all of them in one pass over its bytes."""
    codes = [c.encode() for c in characters]
    table = np.full(256, len(codes), np.uint8 if len(codes) < 256 else np.int64)
    for i, code in enumerate(codes):
        if len(code) == 1:
            table[code[0]] = i
    wide = {int.from_bytes(code.ljust(4, b"\0"), "little"): i for i, code in enumerate(codes) if len(code) > 1}
    numbers = np.array(sorted(wide), np.uint32)
    places = np.array([wide[int(x)] for x in numbers], np.int64)

    @F.arrow_udf("array<bigint>")
    def counts_of(texts: pa.Array) -> pa.Array:
        known = texts.is_valid()
        plain = texts.fill_null("").cast(pa.large_binary())
        ends = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
        data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)
        width, first = len(codes) + 1, 0
        found = np.zeros((len(plain), width), np.int64)
        while first < len(plain):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + COUNTED_BYTES, "right")) - 1)
            part = data[ends[first] : ends[last]]
            row = np.repeat(np.arange(last - first) * width, np.diff(ends[first : last + 1]))
            found[first:last] = np.bincount(row + table[part], minlength=(last - first) * width).reshape(-1, width)
            if len(numbers):
                lead = np.flatnonzero(part >= 0xC0)
                size = 2 + (part[lead] >= 0xE0).astype(np.uint32) + (part[lead] >= 0xF0)
                padded, code = np.concatenate([part, np.zeros(3, np.uint8)]), part[lead].astype(np.uint32)
                for k in range(1, 4):
                    code |= np.where(size > k, padded[lead + k].astype(np.uint32) << np.uint32(8 * k), np.uint32(0))
                at = np.minimum(np.searchsorted(numbers, code), len(numbers) - 1)
                hit = numbers[at] == code
                found[first:last] += np.bincount(row[lead[hit]] + places[at[hit]], minlength=(last - first) * width).reshape(-1, width)
            first = last
        values = pa.array(found[:, : len(codes)].ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(plain) + 1) * len(codes), pa.int32()), values, mask=pa.array(~known.to_numpy(zero_copy_only=False)))

    return counts_of(text)


def stem_dictionary(df: DataFrame, text: str) -> DataFrame:
    """(token, n, stem) of every distinct token. Only the dictionary passes through Python."""

    def stems(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(stem)

    return token_counts(df, text).withColumn("stem", F.pandas_udf(stems, "string")("token"))


def stems_of(words: Column) -> Column:
    """The stem of every token of an array. Row by row, so that it works on streams, where a dictionary cannot be joined."""

    def stems(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, str] = {}
        for batch in batches:
            for row in batch:
                for w in row if row is not None else ():
                    if w not in known:
                        known[w] = stem(w)
            yield batch.map(lambda row: None if row is None else [known[w] for w in row])

    return F.pandas_udf(stems, "array<string>")(words)


def stemmed_tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, stem) for every distinct stem of a row, by way of the dictionary.

    The join has no hint: a small dictionary is broadcast by the planner, a large one is shuffled
    with adaptive splitting of frequent tokens.
    """
    require_columns(df, [key, text])
    words = spread(df.select(key, text)).select(key, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    dictionary = stem_dictionary(df, text).select("token", "stem")
    return words.join(dictionary, "token").select(key, "stem").distinct()


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Sorted distinct tokens with codes from 0: (token, code)."""
    return dense_codes(token_counts(df, text), "token")


def bag_of_words(df: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """Binary bag of words: the sorted codes of the vocabulary words each row contains."""
    require_columns(df, [key, text])
    found = spread(df.select(key, text)).select(key, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    hits = found.join(words, "token").groupBy(key).agg(F.sort_array(F.collect_list("code")).alias("codes"))
    return df.select(key).join(hits, key, "left").select(key, F.coalesce("codes", F.array().cast("array<bigint>")).alias("codes"))


def corpus_stats(df: DataFrame, text: str, tag: str) -> DataFrame:
    """Number of examples, tags and vocabulary words."""
    words = token_counts(df, text).agg(F.count(F.lit(1)).alias("n_words")).scalar()
    return df.agg(F.count(F.lit(1)).alias("n_examples"), F.count_distinct(tag).alias("n_tags")).withColumn("n_words", words)


# --- language gate ----------------------------------------------------------------------------


def language_allowed(text: Column, candidates: Column, wanted: str = "en") -> Column:
    """May a message pass the gate?

    ``candidates`` are (lang, prob) structs, best first. Short texts pass, and so do texts without
    candidates. Otherwise the first candidate that is the wanted language, or any other language
    with enough confidence, decides; if there is none the message passes.
    """
    decisive = F.filter(candidates, lambda c: (c["lang"] == wanted) | (c["prob"] >= LANGUAGE_CONFIDENCE))
    verdict = F.coalesce(F.get(decisive, F.lit(0))["lang"] == wanted, F.lit(True))
    return (F.length(F.trim(text)) < MIN_LANGUAGE_CHARS) | verdict


def _lowered(text: str) -> Column:
    return F.lower(F.coalesce(F.col(text), F.lit("")))


def _mix_word(word: np.ndarray) -> np.ndarray:
    word = word * np.uint32(0xCC9E2D51)
    return (word << 15 | word >> 17) * np.uint32(0x1B873593)


def _mix(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    code = code ^ _mix_word(word)
    return (code << 13 | code >> 19) * np.uint32(5) + np.uint32(0xE6546B64)


def _finish(code: np.ndarray, size: np.ndarray | np.uint32) -> np.ndarray:
    code = code ^ size
    code = (code ^ code >> 16) * np.uint32(0x85EBCA6B)
    code = (code ^ code >> 13) * np.uint32(0xC2B2AE35)
    return code ^ code >> 16


def _gram_hashes(chars: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Murmur3 of every three characters in a row, joined by spaces, as Spark's NGram and HashingTF take it.

    ``chars`` holds the UTF-8 bytes of every character as a little-endian number, ``sizes`` how many they are.
    """
    seed = np.uint32(42)
    # characters of one byte, and then the others
    word = chars[:-2] | chars[1:-1] << 16 | np.uint32(0x20002000)
    hashes = _finish(_mix(seed, word) ^ _mix_word(chars[2:]), np.uint32(5))
    i = np.flatnonzero(sizes[:-2] + sizes[1:-1] + sizes[2:] > 3)
    if not len(i):
        return hashes
    # up to 14 bytes, in two numbers
    wide, bits = chars.astype(np.uint64), 8 * sizes.astype(np.uint64)
    space, word_bits = np.uint64(0x20), np.uint64(64)
    first, second, third = wide[i] | space << bits[i], wide[i + 1] | space << bits[i + 1], wide[i + 2]
    one = bits[i] + 8
    two = one + bits[i + 1] + 8
    inside = two < word_bits
    low = first | second << one | np.where(inside, third << np.where(inside, two, 0), 0)
    high = second >> (word_bits - one) | np.where(inside, third >> np.where(inside, word_bits - two, 0), third << np.where(inside, 0, two - word_bits))
    words = [(x & np.uint64(0xFFFFFFFF)).astype(np.uint32) for x in (low, low >> 32, high, high >> 32)]
    size = ((two + bits[i + 2]) // 8).astype(np.uint32)
    whole, code = size // 4, np.full(len(i), seed)
    for k in range(3):
        code = np.where(k < whole, _mix(code, words[k]), code)
    hashes[i] = _finish(code ^ _mix_word(np.choose(whole, words)), size)
    return hashes


def gram_buckets(texts: pa.Array, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Buckets of the character trigrams of some texts at a time: (first text, buckets of its and the following texts, how many each has)."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + GRAM_BYTES, "right")) - 1)
        part = data[ends[first] : ends[last]]
        starts = np.flatnonzero((part & 0xC0) != 0x80)
        sizes = np.diff(starts, append=len(part)).astype(np.uint32)
        padded = np.concatenate([part, np.zeros(3, np.uint8)]).astype(np.uint32)
        chars = padded[starts]
        for k in range(1, 4):
            chars |= np.where(sizes > k, padded[np.minimum(starts + k, len(part))] << np.uint32(8 * k), np.uint32(0))
        limits = np.searchsorted(starts, ends[first : last + 1] - ends[first])
        lengths = np.maximum(np.diff(limits) - 2, 0)
        begun = np.zeros(len(starts) + 1, bool)
        begun[limits] = True
        inside = ~(begun[1:-2] | begun[2:-1])  # of one text
        yield first, _gram_hashes(chars, sizes).view(np.int32)[inside] % buckets, lengths
        first = last


def _gram_totals(rows: DataFrame, text: str, lang: str, buckets: int) -> DataFrame:
    """(lang, n, grams): number of texts and occurrences of every bucket, one line for each language and task or more."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list] = {}

        def lines() -> pa.RecordBatch:
            names, values = list(held), list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([v[0] for v in values], pa.float64()), pa.array([v[1] for v in values], pa.list_(pa.float64()))], ["lang", "n", "grams"])

        for batch in batches:
            kinds = batch.column(1).dictionary_encode()
            names = [*kinds.dictionary.to_pylist(), None]
            codes = kinds.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
            for first, found, lengths in gram_buckets(batch.column(0), buckets):
                own = codes[first : first + len(lengths)]
                each = np.repeat(own, lengths)
                for code, n in zip(*np.unique(own, return_counts=True)):
                    total = held.setdefault(names[code], [0.0, np.zeros(buckets)])
                    total[0] += n
                    total[1] += np.bincount(found[each == code], minlength=buckets)
                if len(held) > HELD_LANGUAGES:
                    yield lines()
        if held:
            yield lines()

    columns = rows.select(_lowered(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    return columns.mapInArrow(totals, "lang string, n double, grams array<double>")


def fit_language_model(df: DataFrame, text: str, lang: str, buckets: int = 1 << 14) -> PipelineModel:
    """Language model on character trigrams: naive Bayes over the mean text of each language, weighing as much as it has texts."""
    require_columns(df, [text, lang])
    rows = spread(df.select(text, lang)).filter(F.length(text) > 0)
    parts = _gram_totals(rows, text, lang, buckets).withColumn("grams", array_to_vector("grams"))
    sums = parts.groupBy("lang").agg(F.sum("n").alias("__n"), Summarizer.sum(F.col("grams")).alias("sum"))
    means = sums.withColumn("__tf", array_to_vector(F.transform(vector_to_array("sum"), lambda x: x / F.col("__n")))).drop("sum").persist()
    stages = [
        StringIndexer(inputCol="lang", outputCol="__lang", stringOrderType="alphabetAsc"),
        NaiveBayes(featuresCol="__tf", labelCol="__lang", weightCol="__n", probabilityCol="__prob", predictionCol="__pred", rawPredictionCol="__raw"),
    ]
    try:
        return Pipeline(stages=stages).fit(means)
    finally:
        means.unpersist()


def language_candidates(model: PipelineModel, df: DataFrame, text: str) -> DataFrame:
    """Adds ``candidates``, (lang, prob) structs with the most likely language first."""
    indexer, bayes = model.stages
    known = df.sparkSession.sparkContext.broadcast((bayes.pi.toArray(), bayes.theta.toArray()))

    @F.arrow_udf("array<double>")
    def chances_of(texts: pa.Array) -> pa.Array:
        prior, weights = known.value
        scores = np.tile(prior, (len(texts), 1))
        for first, found, lengths in gram_buckets(texts, weights.shape[1]):
            some = np.flatnonzero(lengths)
            begin = (np.cumsum(lengths) - lengths)[some]
            for k in range(len(prior) if len(some) else 0):
                scores[first + some, k] += np.add.reduceat(weights[k][found], begin)
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        scores /= scores.sum(axis=1, keepdims=True)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(prior), pa.int32()), pa.array(scores.ravel()))

    labels = F.array(*[F.lit(x) for x in indexer.labels])
    pairs = F.zip_with(labels, "__prob", lambda lang, p: F.struct(p.alias("prob"), lang.alias("lang")))
    ranked = F.sort_array(pairs, asc=False)
    return df.withColumn("__prob", chances_of(_lowered(text))).withColumn("candidates", ranked).select(*df.columns, "candidates")


# --- intents ----------------------------------------------------------------------------------


def fit_intents(
    df: DataFrame, text: str, tag: str, hidden: Sequence[int] = (8, 8), vocab_size: int | None = None, rounds: int = 100,
    seed: int = 42,
) -> PipelineModel:
    """Intent classifier: binary bag of stems, two small hidden layers, softmax. Without ``vocab_size`` every stem counts."""
    require_columns(df, [text, tag])
    rows = spread(df.select(text, tag)).select(text, tag, stems_of(tokens(F.col(text))).alias("__tokens")).persist()
    if vocab_size is None:
        vocab_size = max(1, rows.select(F.explode("__tokens")).distinct().count())
    words = CountVectorizer(inputCol="__tokens", outputCol="__bag", binary=True, vocabSize=vocab_size).fit(rows)
    tags = StringIndexer(inputCol=tag, outputCol="__tag", stringOrderType="alphabetAsc").fit(rows)
    if len(tags.labels) < 2:
        raise ModelTrainingError("an intent classifier needs at least two tags")
    layers = [len(words.vocabulary), *hidden, len(tags.labels)]
    return PipelineModel([words, tags, fit_network(tags.transform(words.transform(rows)), "__bag", "__tag", layers, rounds, seed)])


def classify(model: PipelineModel, df: DataFrame, text: str) -> DataFrame:
    """Adds n_tokens, n_known (vocabulary hits), tag and confidence. Works on streams too."""
    words, tags, network = model.stages
    assert isinstance(words, CountVectorizerModel)
    bagged = words.transform(df.withColumn("__words", tokens(F.col(text))).withColumn("__tokens", stems_of(F.col("__words"))))
    layers, weights = network.getLayers(), df.sparkSession.sparkContext.broadcast(weights_of(network))

    @F.arrow_udf("struct<n_known:long,place:int,confidence:double>")
    def score(column: pa.Array) -> pa.Array:
        codes, lengths = bags(column)
        p = chances(weights.value, layers, codes, lengths)
        return pa.StructArray.from_arrays([pa.array(lengths), pa.array(p.argmax(axis=1), pa.int32()), pa.array(p.max(axis=1))], ["n_known", "place", "confidence"])

    labels = F.array(*[F.lit(x) for x in tags.labels])
    return bagged.withColumn("__score", score("__bag")).select(
        *df.columns,
        F.size("__words").alias("n_tokens"),
        F.col("__score.n_known").alias("n_known"),
        F.get(labels, F.col("__score.place")).alias("tag"),
        F.col("__score.confidence").alias("confidence"),
    )


def route(df: DataFrame, allowed: Column, key: Column, responses: Column) -> DataFrame:
    """Final tag, confidence and answer of classified messages.

    ``df`` has n_tokens, n_known, tag and confidence; ``responses`` is the answer list of the tag.
    Which answer is given depends on ``key`` only, so a replay gives the same one.
    """
    refused, empty, unknown = ~allowed, F.col("n_tokens") == 0, F.col("n_known") == 0
    failed = F.col("tag").isNull() | F.col("confidence").isNull()
    sure = F.col("confidence") > INTENT_CONFIDENCE
    choice = F.get(responses, F.pmod(F.xxhash64(key), F.greatest(F.size(responses), F.lit(1))).cast("int"))

    def decide(non_english: Column, none: Column, strange: Column, error: Column, other: Column) -> Column:
        return F.when(refused, non_english).when(empty, none).when(unknown, strange).when(failed, error).otherwise(other)

    zero = F.lit(0.0)
    return df.withColumns(
        {
            "answer": decide(
                F.lit(ENGLISH_ONLY), F.lit(FALLBACK), F.lit(FALLBACK), F.lit(FAILED),
                F.when(sure, F.coalesce(choice, F.lit(FALLBACK))).otherwise(F.lit(FALLBACK)),
            ),
            "tag": decide(F.lit("non_english"), F.lit("empty"), F.lit("unrecognized"), F.lit("error"), F.col("tag")),
            "confidence": decide(zero, zero, zero, zero, F.col("confidence")),
        }
    )
