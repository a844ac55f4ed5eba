"""Helpers that several operators of this package share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabkit.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(id_column: str, modulus: int) -> Column:
    """CRC-32 of the id written as text, modulo ``modulus``; a null id counts as 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus, F.lit(0))


#: Slots whose counts one window of ``placed`` sums.
SLOTS_AT_ONCE = 1024


def placed(df: DataFrame, keys: list[str], slot: str, order: list[Column], out: str, total: str | None = None) -> DataFrame:
    """Row position (from 0) within ``keys`` without bringing a key's rows into one task; ``total`` names a column for the key's rows.

    ``slot`` is an integer column that grows with ``order``; a window ranks the rows of one slot, and the counts of the slots before
    it, summed in two levels, give the offset. Slots should hold a bounded number of rows.
    """
    counts = df.groupBy(*keys, slot).agg(F.count("*").alias("_n")).withColumn("_block", F.floor(F.col(slot) / SLOTS_AT_ONCE))
    ahead = lambda by, order_: Window.partitionBy(*by).orderBy(order_).rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy(*keys, "_block").agg(F.sum("_n").alias("_m"))
    blocks = blocks.select(*keys, "_block", F.coalesce(F.sum("_m").over(ahead(keys, "_block")), F.lit(0)).alias("_blocks_before"))
    inside_block = F.coalesce(F.sum("_n").over(ahead([*keys, "_block"], slot)), F.lit(0))
    offsets = counts.withColumn("_slots_before", inside_block).join(blocks, [*keys, "_block"])
    offsets = offsets.select(*keys, slot, (F.col("_slots_before") + F.col("_blocks_before")).alias("_before"))
    if total:
        sizes = counts.groupBy(*keys).agg(F.sum("_n").alias(total))
        offsets = offsets.join(sizes, keys) if keys else offsets.crossJoin(sizes)  # without keys sizes is one row
    inside = F.row_number().over(Window.partitionBy(*keys, slot).orderBy(*order))
    return df.join(offsets, [*keys, slot]).withColumn(out, F.col("_before") + inside - 1).drop("_before")


#: Rows that one task of ``range_ranked`` sorts.
RANGE_ROWS = 1_000_000


def range_ranked(df: DataFrame, order: list[Column], rows: int, out: str) -> DataFrame:
    """Row position (from 1) of each of ``rows`` rows in ``order``: sorted ranges, and the counts of the ranges before.

    Rows that ``order`` does not tell apart may not fill a task, so it should end with an identifier.
    """
    spark = df.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 20_000), rows // RANGE_ROWS)
    ranged = store(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row for each task
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_before") + inside).drop("_part", "_before")


def positions(df: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    """Row position (from 1) within ``key``; rows are sorted in ranges, so a key with a third of all rows is cut into many.

    Rows that neither key nor order tell apart are numbered as they come.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != out]
    rows = df.count()
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 20_000), rows // RANGE_ROWS)
    spread = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(parts, F.col(key), *order, F.col("_tie")).withColumn("_part", F.spark_partition_id())
    ranged = store(ranged, "ranges")
    counts = ranged.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_part", F.sum("_n").over(before).alias("_before")).where("_before > 0")  # at most the first key of a range
    inside = F.row_number().over(Window.partitionBy("_part", key).orderBy(*order, F.col("_tie")))
    placed_ = ranged.withColumn("_in", inside).join(F.broadcast(offsets), [key, "_part"], "left")
    return placed_.select(*columns, (F.col("_in") + F.coalesce("_before", F.lit(0))).cast("long").alias(out))
