"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Only DataFrame functions; nothing runs in Python on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.common import store

WIDTH = 5
SIMILARITY = 0.8
#: Fingerprints have 64 bits in 8 blocks; blocks are probed with all values up to 2 bits away, so any two
#: fingerprints up to 8 * (2 + 1) - 1 = 23 bits apart meet in at least one block.
BLOCKS, BLOCK_BITS, NEAR_BITS = 8, 8, 2
RADIUS = BLOCKS * (NEAR_BITS + 1) - 1
#: Parts into which the places of one window text are dealt.
SALTS = 16


def _words(text: str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingle(words: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + j) for j in range(WIDTH)])


def _shingles(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words) - WIDTH), lambda i: _shingle(words, i))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash; a feature weighs as often as it occurs. A bit is set if most features have it set."""
    votes = lambda b: F.aggregate(hashes, F.lit(0), lambda s, h: s + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1)).cast("int"))
    bit = lambda b: F.when(2 * votes(b) > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(bit(b)))


def _cells(hashes: Column) -> Column:
    """One value for each occurrence of a shingle, so that set operations count repeated shingles."""
    before = lambda h, i: F.size(F.filter(F.slice(hashes, 1, i), lambda x: x == h))
    return F.transform(hashes, lambda h, i: F.xxhash64(h, before(h, i)))


def _block(fingerprint: Column, b: Column) -> Column:
    return F.call_function("shiftrightunsigned", fingerprint, b * BLOCK_BITS).bitwiseAND(F.lit(2**BLOCK_BITS - 1)).cast("int")


def _near_values() -> list[int]:
    """Masks of at most ``NEAR_BITS`` set bits."""
    return [m for m in range(2**BLOCK_BITS) if m.bit_count() <= NEAR_BITS]


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, print_a, print_b, words``: a row is named by its id and 128 bits of its text, since ids may repeat."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    prints = [F.xxhash64(text).alias("print_a"), F.xxhash64(F.lit("text"), text).alias("print_b")]
    return docs.select(F.col(id_column).alias("doc_id"), *prints, _words(text_column).alias("words"))


_KEY = ["doc_id", "print_a", "print_b"]
_CONTENT = ["hash_a", "hash_b", "size"]


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in names])


def _contents(df: DataFrame) -> DataFrame:
    """``df`` with ``hash_a, hash_b``, which name its shingles."""
    return df.withColumn("hash_a", F.xxhash64("hashes")).withColumn("hash_b", F.xxhash64(F.lit("shingles"), F.col("hashes")))


def _leaks(docs: DataFrame, benchmark: DataFrame, id_column: str, text_column: str, item_column: str, item_text: str, similarity: float) -> DataFrame:
    """``doc_id, print_a, print_b, item_id, similarity, start`` of every window that matches an item."""
    items = benchmark.select(F.col(item_column).alias("item_id"), _words(item_text).alias("words")).where(F.size("words") >= WIDTH)
    items = store(_contents(items.select("item_id", F.size("words").alias("size"), _shingles(F.col("words")).alias("hashes"))), "items")
    places = items.dropDuplicates(_CONTENT).select("size", F.posexplode("hashes").alias("place", "h"), "hashes")
    before = F.when(F.col("place") > 0, F.get("hashes", F.col("place") - 1)).alias("before")
    places = store(places.select("h", "size", "place", before).dropDuplicates(), "item-shingles")
    longest = items.agg(F.coalesce(F.max("size"), F.lit(WIDTH))).first()[0]

    # only the row's name and two shingle hashes of a position go through the join, never its words
    keyed = _keyed(docs, id_column, text_column)
    every = F.when(F.size("words") >= WIDTH, F.sequence(F.lit(0), F.size("words") - WIDTH))
    at = keyed.select(*_KEY, "words", F.size("words").alias("n"), F.explode(every).alias("q"))
    ahead = F.when(F.col("q") > 0, _shingle(F.col("words"), F.col("q") - 1)).alias("ahead")
    at = at.select(*_KEY, "n", "q", _shingle(F.col("words"), F.col("q")).alias("h"), ahead)
    met = at.join(places, "h").where(F.col("before").isNull() | F.col("ahead").isNull() | (F.col("ahead") != F.col("before")))
    first = F.greatest(F.lit(0), F.col("q") - F.col("place"))
    last = F.least(F.col("n"), F.col("q") - F.col("place") + F.col("size"))
    laid = store(met.select(*_KEY, "size", first.alias("start"), last.alias("last")).dropDuplicates(), "windows-laid")

    # the words of the few rows that met, in stretches no longer than two of the longest items
    stretch = max(256, longest)
    named = store(laid.select(*_KEY).dropDuplicates(), "windows-rows")
    rows = keyed.join(named, _same(keyed, named, _KEY), "left_semi")
    cut = rows.dropDuplicates(_KEY).select(*_KEY, "words", F.explode(F.sequence(F.lit(0), ((F.size("words") - 1) / stretch).cast("int"))).alias("part"))
    cut = cut.select(*[F.col(c).alias(f"_{c}") for c in _KEY], F.col("part").alias("_part"), F.slice("words", F.col("part") * stretch + 1, 2 * stretch).alias("words"))
    # a stretch meets all its windows as one row, so its words are sent once
    ranges = F.collect_list(F.struct("size", "start", "last")).alias("ranges")
    grouped = laid.withColumn("part", (F.col("start") / stretch).cast("int")).groupBy(*_KEY, "part").agg(ranges)
    own = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*_KEY, "part"]])
    each = grouped.join(cut, own).select(*_KEY, "part", "words", F.explode("ranges").alias("r")).select(*_KEY, "part", "words", "r.*")
    window = F.slice("words", F.col("start") - F.col("part") * stretch + 1, F.col("last") - F.col("start"))
    windows = each.select(*_KEY, "size", "start", _shingles(window).alias("hashes"))
    windows = store(_contents(windows), "windows")

    # equal windows and equal items are compared once, by fingerprints alone; their shingles are fetched for what is near
    prints = lambda df: store(df.dropDuplicates(_CONTENT).select(*_CONTENT, "hashes", simhash(F.col("hashes")).alias("fingerprint")), "fingerprints")
    left_prints, right_prints = prints(windows), prints(items)
    blocks = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    left = left_prints.drop("hashes").select("*", blocks.alias("b")).withColumn("v", _block(F.col("fingerprint"), F.col("b")))
    masks = F.array(*[F.lit(m) for m in _near_values()])
    right = (
        right_prints.select("size", F.col("hash_a").alias("item_a"), F.col("hash_b").alias("item_b"), F.col("fingerprint").alias("item_print"), blocks.alias("b"))
        .withColumn("mask", F.explode(masks))
        .withColumn("v", _block(F.col("item_print"), F.col("b")).bitwiseXOR(F.col("mask")))
        .drop("mask")
    )
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print")))
    # of the blocks in which a pair meets only the first counts, so that a pair is one candidate
    near_block = lambda b: F.bit_count(_block(F.col("fingerprint"), b).bitwiseXOR(_block(F.col("item_print"), b)).cast("long")) <= NEAR_BITS
    earlier = reduce(lambda a, c: a | c, [(F.col("b") > k) & near_block(F.lit(k)) for k in range(BLOCKS - 1)])
    near = left.join(right, ["size", "b", "v"]).where((distance <= RADIUS) & ~earlier).select(*_CONTENT, "item_a", "item_b")
    item_side = right_prints.select("size", F.col("hash_a").alias("item_a"), F.col("hash_b").alias("item_b"), F.col("hashes").alias("item_hashes"))
    pairs = near.join(left_prints.select(*_CONTENT, "hashes"), _CONTENT).join(item_side, ["size", "item_a", "item_b"])
    both = F.size(F.array_intersect(_cells(F.col("hashes")), _cells(F.col("item_hashes"))))
    share = both / (F.size("hashes") + F.size("item_hashes") - both)
    checked = pairs.select(*_CONTENT, "item_a", "item_b", share.alias("similarity")).where(F.col("similarity") >= similarity)
    ids = items.select("item_id", "size", F.col("hash_a").alias("item_a"), F.col("hash_b").alias("item_b"))
    matched = store(checked.join(ids, ["size", "item_a", "item_b"]).drop("item_a", "item_b"), "matches")
    # one window may stand in a third of all documents: its matches are copied, its places dealt
    salted = matched.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = windows.select(*_KEY, *_CONTENT, "start", F.pmod(F.xxhash64(*_KEY, "start"), F.lit(SALTS)).cast("int").alias("salt"))
    return dealt.join(salted, [*_CONTENT, "salt"]).select(*_KEY, "item_id", "similarity", "start")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id, item_id, similarity, start`` of every document that holds a benchmark item, whole or nearly.

    Texts are lower-case runs of letters and digits; an item of L words is held against windows of L words. The similarity is
    the weighted Jaccard similarity of five-word shingles, weights being counts; ``start`` is the first word of
    the best window (the earliest of equals). One row per document and item.

    A window without a shingle of the benchmark has similarity 0, so windows are fingerprinted where a document has
    one, each laid so that the shingle is where an item of that size has it. Fingerprints of windows and of items
    of the same size meet by blocks (see ``RADIUS``), and what is within the radius is verified exactly. Texts of
    similarity 0.8 differ in 10 of 64 bits on average; more than ``RADIUS`` is beyond four standard deviations.

    Null texts, and documents or items of fewer than five words, match nothing. Null ids are results like
    others; repeated rows give one result, and different texts under one id are matched each and reported together. Positions of
    a text of any length go through the joins one by one, without its words. The benchmark side is a stored table: Spark broadcasts it
    only if its size is known to be small.
    """
    found = _leaks(docs, benchmark, id_column, text_column, item_column, item_text, similarity)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
    return best.select("doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start"))


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose own text holds no benchmark item; ids may be null or repeat."""
    found = _leaks(docs, benchmark, id_column, text_column, item_column, item_text, similarity)
    leaks = store(found.select(*[F.col(c).alias(f"_{c}") for c in _KEY]).dropDuplicates(), "leaks")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    same = F.col(id_column).eqNullSafe(F.col("_doc_id")) & (F.xxhash64(text) == F.col("_print_a")) & (F.xxhash64(F.lit("text"), text) == F.col("_print_b"))
    return docs.join(leaks, same, "left_anti").select(docs.columns)
