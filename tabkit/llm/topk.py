"""Exact top-k by inner product: tiled matrix products, partial selection, merge of top lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.common import store

#: Vectors that one task multiplies at a time: candidates of a shard, queries of a block.
SHARD_ROWS = 32_768
BLOCK_ROWS = 2_048
#: Candidates of one product; bounds the score matrix of a tile.
TILE_ROWS = 2_048
#: Shards whose top lists are merged in the first step.
FAN_IN = 64
EXACT = 2.0**53
LONG = 2**63 - 1

_PARTIAL = "query_id long, vec_id long, score long, shard long"


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = len(column)
    flat = column.combine_chunks().flatten() if rows else pa.array([], pa.float64())
    return np.asarray(flat, dtype=np.float64).reshape(rows, -1)


def _products(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in doubles while every sum stays below 2**53, else in Python integers."""
    bound = np.abs(queries).sum(axis=1).max(initial=0) * np.abs(tile).max(initial=0)
    if bound < EXACT:
        return (queries @ tile.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(queries) @ whole(tile).T, -LONG, LONG).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, best first, ties to the smaller id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= cut)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def _cell(k: int):
    def top_lists(candidates: pa.Table, block: pa.Table) -> pa.Table:
        if not len(candidates) or not len(block):  # an empty side has no columns
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score", "shard")})
        c_ids, q_ids = np.asarray(candidates["vec_id"], dtype=np.int64), np.asarray(block["query_id"], dtype=np.int64)
        c_matrix, q_matrix = _matrix(candidates["vector"]), _matrix(block["query"])
        kept_s = [np.empty(0, np.int64)] * len(q_ids)
        kept_c = [np.empty(0, np.int64)] * len(q_ids)
        for at in range(0, len(c_ids), TILE_ROWS):
            tile_ids = c_ids[at : at + TILE_ROWS]
            scores = _products(q_matrix, c_matrix[at : at + TILE_ROWS])
            for i, own in enumerate(q_ids):
                others = tile_ids != own
                row, ids = (scores[i], tile_ids) if others.all() else (scores[i][others], tile_ids[others])
                near = best_of(row, ids, k)
                row, ids = np.concatenate([kept_s[i], row[near]]), np.concatenate([kept_c[i], ids[near]])
                near = best_of(row, ids, k)
                kept_s[i], kept_c[i] = row[near], ids[near]
        out_q = np.repeat(q_ids, [len(x) for x in kept_c])
        out_c, out_s = np.concatenate(kept_c), np.concatenate(kept_s)
        shard = candidates["shard"][0].as_py()
        return pa.table(
            {
                "query_id": pa.array(out_q, pa.int64()),
                "vec_id": pa.array(out_c, pa.int64()),
                "score": pa.array(out_s, pa.int64()),
                "shard": pa.array(np.full(len(out_q), shard), pa.int64()),
            }
        )

    return top_lists


def exact_topk(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """The ``k`` highest inner products of each query row against every other row.

    Components are turned into ``floor(scale * x)``, so scores are integers and ties are real ties; they go
    to the smaller id. Result: ``query_id, rank, vec_id, score``, fewer than ``k`` rows where there are
    fewer candidates.

    Candidates are dealt into shards and queries into blocks; each (shard, block) cell is one task that
    multiplies tile by tile and keeps ``k`` per query, and the lists of the shards are merged in two steps.
    Neither side is broadcast, both cell sides are bounded.

    Rows without id or vector, or with a null, NaN or infinite component, take no part. Vectors are compared
    with vectors of the same length only. Equal rows count once; a row never meets rows of its own id, and of
    several rows with one id the best scores are kept. Scores outside 64 bits are clipped. Other columns
    are ignored.
    """
    x = F.col(vector_column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = store(
        df.where(F.col(id_column).isNotNull() & x.isNotNull() & finite)
        .select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.transform(x, lambda v: _floored(v, scale)).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        )
        .dropDuplicates()
        .withColumn("dim", F.size("vector"))
        .withColumn("h", F.xxhash64("vec_id", "vector")),
        "vectors",
    )
    sizes = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0)).alias("q")).first()
    shards, blocks = -(-max(1, sizes["n"]) // SHARD_ROWS), -(-max(1, sizes["q"]) // BLOCK_ROWS)
    candidates = rows.select(
        "vec_id", "vector", "dim",
        F.pmod("h", F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    queries = rows.where("is_query").select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.col("dim").alias("dim"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int").alias("block"),
    )
    cell = ["dim", "shard", "block"]
    lists = candidates.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInArrow(_cell(k), _PARTIAL)
    best = [F.desc("score"), F.asc("vec_id")]
    part = (
        lists.groupBy("query_id", "vec_id", F.floor(F.col("shard") / FAN_IN).alias("part"))
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "part").orderBy(*best)))
        .where(F.col("rank") <= k)
    )
    merged = part.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _floored(v: Column, scale: float) -> Column:
    """Floor in doubles; Spark's floor returns a long, which large components would overflow."""
    scaled = v.cast("double") * F.lit(scale)
    return F.when(F.abs(scaled) < F.lit(EXACT), F.floor(scaled).cast("double")).otherwise(scaled)
