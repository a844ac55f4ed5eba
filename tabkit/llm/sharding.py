"""Proportional stratified interleaving: shards whose mixture of sources matches the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.common import placed, store

#: Rows that one window ranks at a time.
SLOT_ROWS = 20_000
_UNIT = float(2**60)


def _draw(seed: int, *columns: Column) -> Column:
    """A seeded 60-bit number from a row's values: the same on every cluster and after a retry."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def stratified_shards(
    df: DataFrame,
    shards: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "source",
    seed: int = 17,
) -> DataFrame:
    """Deal rows to ``shards`` shards of equal row count, each with the sources in the same proportions.

    Rows of a source are shuffled by a seeded hash and ranked; a row's fractional rank is
    ``(rank + phase) / rows of its source``, where the phase in [0, 1) is a seeded draw for each source that keeps
    sources of equal size from coming in step. All rows are sorted by fractional rank (ties by the hash) and the
    order is cut into runs whose lengths differ by at most one. In every run each source has its share
    of rows give or take a few.

    Result: id, source, ``size`` (UTF-8 bytes + 8), ``text_crc32``, ``law`` (always ``rows``), ``shard``,
    ``slot`` (gapless from 0), ``grown_shard`` (null: the law does not keep rows in place when shards are
    added). Null text counts as empty; null sources form a stratum of their own; null ids and repeated rows
    are dealt like others; an empty table gives no rows. Equal texts are not kept together.

    Ranks come from windows over hash ranges of about ``SLOT_ROWS`` rows plus offsets, so a source with a
    third of all rows is ranked by many tasks.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    base = df.select(
        F.col(id_column).alias("doc_id"),
        F.col(stratum_column).alias("source"),
        F.col(stratum_column).isNull().alias("bare"),
        F.coalesce(F.col(stratum_column).cast("string"), F.lit("")).alias("stratum"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    draw = _draw(seed, F.col("doc_id"), F.col("text_crc32"), F.col("size"))
    rows = store(base.withColumn("draw", draw), "shard-rows")
    strata = ["bare", "stratum"]
    order = [F.col("draw"), F.col("doc_id"), F.col("text_crc32")]
    phase = _draw(seed, F.lit("phase"), F.col("bare").cast("int"), F.col("stratum")) / _UNIT
    total = rows.count()
    slices = -(-max(1, total) // SLOT_ROWS)
    # cut by the draw alone, so that no join or exchange is on the source alone
    sliced = rows.withColumn("slice", F.floor(F.col("draw") / _UNIT * slices).cast("int"))
    ranked = placed(sliced, strata, "slice", order, "rank", "n_source").withColumn("share", (F.col("rank") + phase) / F.col("n_source"))
    ranked = store(ranked.withColumn("slice", F.floor(F.col("share") * slices).cast("int")), "shard-ranks")
    dealt = placed(ranked, [], "slice", [F.col("share"), *order], "place").withColumn(
        "shard", F.expr(f"(place * {shards}) div {max(1, total)}").cast("int")
    )
    first = F.expr(f"(shard * CAST({total} AS BIGINT) + {shards - 1}) div {shards}")
    return dealt.select(
        "doc_id", "source", "size", "text_crc32",
        F.lit("rows").alias("law"), "shard",
        (F.col("place") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(dealt: DataFrame, docs: DataFrame, path: str, id_column: str = "doc_id") -> None:
    """Write whole documents by shard, in slot order; ids must be unique and not null."""
    placement = dealt.select(F.col("doc_id").alias("_id"), "shard", "slot")
    joined = docs.join(placement, docs[id_column] == F.col("_id")).drop("_id")
    joined.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
