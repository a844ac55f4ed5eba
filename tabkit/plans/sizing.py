"""Size checks that decide between a one-pass plan and a range-partitioned one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Inputs estimated below this many bytes (one usual partition) may be handled by one task.
SMALL_BYTES = 128 * 1024 * 1024
#: Below this many bytes one aggregate buffer may hold all values.
TINY_BYTES = 1024 * 1024
#: Most rows a lookup side may have before it stops being broadcast.
MAX_BROADCAST_ROWS = 10_000


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate; unknown sources count as huge."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def _limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.tabkit.smallBytes", str(SMALL_BYTES)))


def is_small(df: DataFrame) -> bool:
    """Does the estimate fit one task? The limit is ``spark.tabkit.smallBytes``.

    Estimates of joins and of unknown sources are far too high, never too low; a caller that gets
    False may store its rows, count them and ask :func:`rows_fit`.
    """
    return estimated_bytes(df) <= _limit(df)


def _row_bytes(df: DataFrame) -> int:
    return 64 * len(df.columns)


def rows_fit(stored: DataFrame, n: int) -> bool:
    """Do ``n`` counted rows fit one task?"""
    return n * _row_bytes(stored) <= _limit(stored)


def range_partitions(stored: DataFrame, n: int) -> int:
    """How many range partitions ``n`` counted rows are cut into: at most about 128 MB each."""
    default = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(min(default, n // 50_000 + 1), n * _row_bytes(stored) // (128 * 1024 * 1024))


def lookup_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows; otherwise leave it to a shuffle join.

    The check fetches at most ``max_rows + 1`` rows, so it is bounded on the driver too.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame) -> DataFrame:
    """Hand a small input that needs much work per row to all cores.

    A file with a single row group is read by one task. Inputs beyond a gigabyte arrive in enough
    tasks by themselves and are left alone.
    """
    size = estimated_bytes(df)
    if not TINY_BYTES <= size <= 1 << 30:
        return df
    return df.repartition(int(min(df.sparkSession.sparkContext.defaultParallelism, max(1, size >> 18))))
