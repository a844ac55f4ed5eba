"""Near-duplicate classes of documents: DartMinHash signatures, banded joining, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.bpe import text_chunks
from tabkit.llm.common import store
from tabkit.llm.shingles import cells, common, mixed, multipliers, text_words

WIDTH = 5
SIMILARITY = 0.8
#: Two texts of similarity 0.8 share no band with a probability of (1 - 0.8**5)**32, about 3 in a million.
BANDS, ROWS = 32, 5
_NONE = np.uint64(2**64 - 1)
#: Rounds in which members outside a bucket's largest component try one member of it.
TRIALS = 2
#: Text bytes whose darts one task throws at a time.
DART_BYTES = 4 << 20


def dart_signatures(cell: np.ndarray, until: np.ndarray, size: int) -> np.ndarray:
    """Weighted MinHash signatures, (texts, size); a text without cells has only ``2**64 - 1``.

    Every unit cell receives darts as a Poisson process: dart by dart, a hash of (cell, dart number) gives the gap to the next
    rank and the coordinate it lands on. Darts depend on the cell alone, so equal cells throw equal darts in every
    text. A text of n cells keeps darts up to rank ``size * (ln(size) + 2) / n``; each coordinate keeps its earliest dart.
    A text with a coordinate that got none throws again up to twice the rank.
    """
    counts = np.diff(until)
    table = np.full((len(counts), size), _NONE, np.uint64)
    with np.errstate(divide="ignore"):
        limit = size * (np.log(size) + 2) / counts
    todo = np.flatnonzero(counts)
    while len(todo):
        table[todo] = _NONE
        text = np.repeat(todo, counts[todo])
        own = cell[np.repeat(until[todo] - (np.cumsum(counts[todo]) - counts[todo]), counts[todo]) + np.arange(len(text))]
        rank, most, dart = np.zeros(len(text)), limit[text], 0
        while len(own):
            dart += 1
            draw = mixed(own + np.uint64(dart * 0xD1B54A32D192ED03 & 2**64 - 1))
            rank = rank - np.log(((draw >> np.uint64(11)).astype(float) + 1) * 2.0**-53)
            alive = rank <= most
            if not alive.all():
                own, rank, most, text, draw = own[alive], rank[alive], most[alive], text[alive], draw[alive]
            draw = mixed(draw)
            coordinate = (draw >> np.uint64(32)).astype(np.int64) * size >> 32
            key = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF))
            np.minimum.at(table.reshape(-1), text * size + coordinate, key)
        todo = todo[(table[todo] == _NONE).any(axis=1)]
        limit[todo] *= 2
    return table


def band_hashes(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit number for each text and band; bands never share numbers by design."""
    parts = (table.reshape(len(table), bands, rows) * multipliers(rows, 2)).sum(axis=2, dtype=np.uint64)
    return mixed(mixed(parts) + multipliers(bands, 3))


def signatures(df: DataFrame, id_column: str, text_column: str, width: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, digest, weight, bands`` of every row; ``digest`` and ``bands`` are null if the text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", DART_BYTES):
                words, offsets, digests = text_words(chunk["text"])
                cell, until = cells(words, offsets, width)
                hashes = band_hashes(dart_signatures(cell, until, bands * rows), bands, rows).view(np.int64)
                weight = np.diff(until)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(weight) + 1) * bands, pa.int32()),
                    pa.array(hashes.reshape(-1), pa.int64()),
                    mask=pa.array(weight == 0),
                )
                yield pa.record_batch(
                    {
                        "doc_id": chunk["doc_id"],
                        "digest": pa.array(digests, pa.binary()),
                        "weight": pa.array(weight, pa.int64()),
                        "bands": lists,
                    }
                )

    rows_ = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows_.mapInArrow(run, "doc_id long, digest binary, weight long, bands array<long>")


def _cells_of(df: DataFrame, ids: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """Sorted cells, as bytes, of the documents in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                words, offsets, _ = text_words(chunk["text"])
                cell, until = cells(words, offsets, width)
                parts = zip(until[:-1].tolist(), until[1:].tolist(), strict=True)
                yield pa.record_batch(
                    {
                        "id": chunk["id"],
                        "cells": pa.array([np.sort(cell[a:b]).tobytes() for a, b in parts], pa.binary()),
                    }
                )

    texts = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return texts.join(ids, "id", "left_semi").mapInArrow(run, "id long, cells binary")


def _similarities(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The exact weighted Jaccard similarity ``sim`` of every pair (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch["cells_a"], batch["cells_b"]
            sim = np.empty(batch.num_rows)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64)
                same = common(x, y)
                sim[i] = same / (len(x) + len(y) - same)
            yield pa.record_batch({"a": batch["a"], "b": batch["b"], "sim": pa.array(sim, pa.float64())})

    side = lambda s: known.select(F.col("id").alias(s), F.col("cells").alias(f"cells_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long, sim double")


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` of every end of an edge (a, b); the label is the least id that it is linked with.

    Each round takes the least label of all neighbours, then the label of that label. Rounds go to the shared
    folder; the driver sees only how many labels changed.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).dropDuplicates()
    both = store(both, "links")
    labels = store(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy("a").agg(F.min("label").alias("near"))
        )
        step = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("label").alias("lower"))
        moved = store(step.join(jump, "low", "left").select("id", F.least("low", "lower").alias("label"), F.col("label").alias("old")), "labels")
        changed = moved.where("label <> old").limit(1).count()
        labels = moved.select("id", "label")
        if not changed:
            return labels


def _unsettled(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets whose members are in several components, with the label of the bucket's largest."""
    named = crowded.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = store(named, "buckets-named")
    parts = named.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    several = (
        parts.groupBy("bucket").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("parts"))
        .where("parts > 1").select("bucket", F.col("top.label").alias("largest"))
    )
    return store(named.join(several, "bucket"), "buckets-open")


def _cell_rows(ids: DataFrame, known: DataFrame) -> DataFrame:
    """``id, cell`` of all cells of the texts in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = np.frombuffer(batch["cells"][i].as_buffer(), np.int64)
                yield pa.record_batch({"cell": pa.array(cell), "id": pa.array(np.full(len(cell), batch["id"][i].as_py()), pa.int64())})

    return known.join(ids, "id", "left_semi").mapInArrow(run, "cell long, id long")


def _alone(ids: DataFrame, known: DataFrame) -> DataFrame:
    """For each id, how many of its cells (``alone``) no other text of ``ids`` has."""
    once = _cell_rows(ids, known).groupBy("cell").agg(F.min("id").alias("id"), F.max("id").alias("last")).where("id = last")
    counted = once.groupBy("id").agg(F.count("*").alias("alone"))
    return ids.join(counted, "id", "left").select("id", F.coalesce("alone", F.lit(0)).alias("alone"))


def _possible(similarity: float) -> Column:
    """Whether texts x and y may be similar: cells that only one text has are in no intersection, and 1 - similarity is a metric."""
    n = F.col("nx") + F.col("ny")
    shared = F.least(F.col("nx") - F.col("ux"), F.col("ny") - F.col("uy"))
    return (shared >= similarity / (1 + similarity) * n - 1e-6) & (F.abs(F.col("sx") - F.col("sy")) <= 1 - similarity + 1e-9)


def _sides(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = (("id", ""), ("label", "l"), ("n", "n"), ("alone", "u"), ("sim", "s"))
    side = lambda z: [F.col(c).alias(f"{p}{z}") for c, p in names]
    rest = left.where("id <> lead").select("bucket", "largest", *side("y"))
    return left.where("label <> largest AND id <> lead").select("bucket", *side("x")), rest


def _one_each(left: DataFrame, seed: int, similarity: float) -> DataFrame:
    """Each member outside the largest component with one member of it that shares most, another one in every bucket."""
    stray, rest = _sides(left)
    near = rest.where("ly = largest").groupBy("bucket").agg(
        F.min(F.struct("uy", F.xxhash64("bucket", "y", F.lit(seed)).alias("draw"), "y", "ny", "sy")).alias("t")
    )
    pairs = stray.join(near.select("bucket", "t.y", "t.ny", "t.uy", "t.sy"), "bucket").where(_possible(similarity))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).dropDuplicates()


def _all_left(left: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """All pairs of different components that may be similar, by an exact prefix join.

    All cells are ordered by how many texts have them, the rarest first. Two texts of at least ``similarity`` s share a cell among the first
    ``n - ceil(s n) + 1`` of each, and from their first common cell on enough cells are left for the overlap that s asks for. So texts that
    share a base and differ in rare cells never meet.
    """
    texts = store(left.groupBy("id").agg(F.first("label").alias("label"), F.first("n").alias("n")), "prefix-texts")
    rows = store(_cell_rows(texts.select("id"), known), "prefix-cells")
    often = rows.groupBy("cell").agg(F.count("*").alias("texts"))
    first = F.row_number().over(Window.partitionBy("id").orderBy("texts", "cell")) - 1  # the cells of one text
    prefix = rows.join(often, "cell").withColumn("at", first).join(texts, "id")
    prefix = store(prefix.where((F.col("texts") > 1) & (F.col("at") <= F.col("n") - F.ceil(similarity * F.col("n") - 1e-9))).drop("texts"), "prefixes")
    x, y = (prefix.select("cell", *[F.col(c).alias(f"{c}{k}") for c in ("id", "label", "n", "at")]) for k in "xy")
    rest = 1 + F.least(F.col("nx") - F.col("atx") - 1, F.col("ny") - F.col("aty") - 1)
    enough = (rest >= similarity / (1 + similarity) * (F.col("nx") + F.col("ny")) - 1e-6) & (F.least("nx", "ny") >= similarity * F.greatest("nx", "ny") - 1e-6)
    met = x.join(y, "cell").where((F.col("idx") < F.col("idy")) & (F.col("labelx") != F.col("labely")) & enough)
    return met.select(F.col("idx").alias("a"), F.col("idy").alias("b")).dropDuplicates()


def near_duplicate_classes(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, class_id``; documents of one class are linked by similar texts.

    Texts are linked when the weighted Jaccard similarity of their word shingles (lower case, weights are counts) is at
    least ``similarity``; a class is a connected component and its id the least document id in it.

    Equal word sequences are first reduced to one text. Texts that share a band of the signature are candidates: every member of a
    bucket is compared with the bucket's least id. In buckets whose members are not yet all in one component, members
    outside the largest one are then compared with one member of it, ``TRIALS`` times; what is left goes through an exact prefix
    join. So every pair of a bucket is compared, ruled out, or already in one component, without comparing all pairs of a large class.

    Rows with null id, or null, empty or blank text, are classes of their own. Rows that repeat an id count as one
    document with all its texts. No rows give no rows. Other columns are ignored.
    """
    sig = store(signatures(df, id_column, text_column, width, bands, rows), "signatures")
    whole = sig.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    firsts = store(whole.groupBy("digest").agg(F.min("doc_id").alias("rep")), "distinct-texts")
    reps = firsts.select(F.col("rep").alias("doc_id")).dropDuplicates()
    members = whole.join(reps, "doc_id", "left_semi").select(
        F.explode("bands").alias("bucket"), F.col("doc_id").alias("id"), F.col("weight").alias("n")
    )
    crowds = members.groupBy("bucket").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last")
    crowded = store(members.join(crowds.select("bucket", "lead"), "bucket"), "buckets")

    involved = crowded.select("id").dropDuplicates()
    known = store(_cells_of(df, involved, id_column, text_column, width), "cells")
    lead = crowded.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).dropDuplicates()
    to_lead = store(_similarities(lead, known), "similarities")
    edges = to_lead.where(F.col("sim") >= similarity).select("a", "b")
    labels = components(edges)
    left = _unsettled(crowded, labels).drop("label", "largest")
    unshared = _alone(left.select("id").dropDuplicates(), known)
    own = to_lead.select(F.col("a").alias("lead"), F.col("b").alias("id"), "sim")
    most = F.col("n") - F.col("alone") >= similarity * F.col("n") - 1e-6  # else no text can be similar to it
    left = left.join(unshared, "id").where(most | (F.col("id") == F.col("lead")))
    crowded = store(left.join(own, ["lead", "id"], "left"), "buckets-left")
    for seed in range(TRIALS + 1):
        left = _unsettled(crowded, labels)
        if not left.limit(1).count():
            break
        pairs = _one_each(left, seed, similarity) if seed < TRIALS else _all_left(left, known, similarity)
        found = store(_similarities(pairs, known).where(F.col("sim") >= similarity), "edges").select("a", "b")
        if found.limit(1).count():
            edges = edges.union(found)
            labels = components(edges)

    classes = firsts.join(labels, firsts["rep"] == labels["id"], "left").select(
        "digest", F.coalesce("label", "rep").alias("class_id")
    )
    own = sig.select("doc_id", "digest")
    return own.join(classes, "digest", "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))


#: Rows whose id is null or stands for several texts are numbered by a hash of id and text, from here on.
_ODD_IDS = 1 << 62


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``df``, all columns, without all but one document of each near-duplicate class.

    The document with the least id stays; rows that repeat id and text are reduced to one. Rows whose id is null or stands for several texts
    are decided one by one by id and text, after all others. Texts without words stay.
    """
    id_, text = F.col(id_column).cast("long"), F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    prints = df.select(id_.alias("_repeated"), F.xxhash64(text).alias("_print")).where("_repeated IS NOT NULL")
    repeated = prints.groupBy("_repeated").agg(F.count("*").alias("_times"), (F.min("_print") < F.max("_print")).alias("_several"))
    repeated = store(repeated.where("_times > 1").drop("_times"), "repeated-ids")
    names = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(df.columns)]
    rows = df.select(*names, id_.alias("_id"), text.alias("_text")).join(repeated, F.col("_id") == F.col("_repeated"), "left")
    odd = F.col("_id").isNull() | F.coalesce("_several", F.lit(False))
    hashed = F.lit(_ODD_IDS) + F.xxhash64("_id", "_text").bitwiseAND(F.lit((1 << 61) - 1))
    rows = rows.withColumn("_row", F.when(odd, hashed).otherwise(F.col("_id")))
    classes = store(near_duplicate_classes(rows.select("_row", "_text"), "_row", "_text", **options), "classes")
    extra = store(classes.where("class_id <> doc_id").select(F.col("doc_id").alias("_row")).dropDuplicates(), "extra")
    kept = rows.join(extra, "_row", "left_anti")
    if repeated.limit(1).count() or df.where(id_.isNull()).limit(1).count():
        again = F.col("_id").isNull() | F.col("_repeated").isNotNull()
        kept = kept.where(~again).unionByName(kept.where(again).dropDuplicates(["_row"]))
    return kept.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(df.columns)])
