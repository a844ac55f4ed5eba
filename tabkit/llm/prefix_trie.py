"""Tries of conversation prefixes: ROLLUP over positional turn columns, block after block."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.common import positions, store

#: Turn columns of a block, and blocks (or nodes) of a conversation that one window sums.
BLOCK = 8
SLICE = 1024
#: A node with more children than this, and than a thousandth of all nodes, sends its name to them by broadcast; there are under a thousand.
CROWD = 10_000
#: Conversations whose ids differ only in the last so many bits are joined into one string.
CHUNK_BITS = 12
_LANES = ("k0", "k1", "k2", "k3")
_MASK = 2**32 - 1


@dataclass(frozen=True)
class Trie:
    """``nodes``: one row per distinct prefix; ``ends``: conversation and the node (``node_a, node_b``) it ends at."""

    nodes: DataFrame
    ends: DataFrame


def turn_id(role: Column, text: Column) -> Column:
    """Twenty bytes for a turn: 16 of the SHA-256 of role and text, and the code points of the text; null counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat_ws("", F.length(role), F.lit(":"), role, text).cast("binary"), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.length(text)), 8, "0")))


def numbered_turns(
    conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """``conv_id, place, turn_id``: the turns of each conversation by ``turn`` (null first), numbered from 1.

    Turns with equal numbers go by their digest; repeated rows are turns of their own. Rows without a conversation id belong to no
    conversation and are left out.
    """
    turns = conversations.select(
        F.col(id_column).alias("conv_id"), F.col(turn_column).alias("turn"), turn_id(F.col(role_column), F.col(text_column)).alias("turn_id")
    ).where("conv_id IS NOT NULL")
    return positions(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("turn_id")], "place").drop("turn")


def _mixed(place: Column, turn: Column) -> list[Column]:
    """Four 32-bit numbers of a turn at a place; their sums modulo 2**32 name a prefix."""
    a, b = F.xxhash64(place.cast("long"), turn), F.xxhash64(turn, place.cast("long"), F.lit("prefix"))
    low = lambda x: x.bitwiseAND(F.lit(_MASK))
    return [low(a), F.shiftrightunsigned(a, 32), low(b), F.shiftrightunsigned(b, 32)]


def _name(lanes: list[Column]) -> tuple[Column, Column]:
    cut = [x.bitwiseAND(F.lit(_MASK)) for x in lanes]
    return F.shiftleft(cut[1], 32).bitwiseOR(cut[0]), F.shiftleft(cut[3], 32).bitwiseOR(cut[2])


def _sums_before(df: DataFrame, key: str, part: str, order: str, sums: dict[str, str]) -> DataFrame:
    """For each ``name: column`` the sum of ``column`` over the earlier rows of the same key.

    ``part`` grows with ``order`` and cuts a key's rows into slices of bounded size, each summed by its own window; the sums of the
    earlier slices are added.
    """
    rows = Window.partitionBy(key, part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    slices = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.select("*", *[F.coalesce(F.sum(c).over(rows), F.lit(0)).alias(n) for n, c in sums.items()])
    offsets = df.groupBy(key, part).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    offsets = offsets.select(F.col(key).alias("_key"), F.col(part).alias("_part"), *[F.sum(n).over(slices).alias(f"_{n}") for n in sums])
    offsets = offsets.where("_part > 0")
    joined = inside.join(offsets, (F.col(key) == F.col("_key")) & (F.col(part) == F.col("_part")), "left")
    total = [(F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0))).alias(n) for n in sums]
    return joined.select(*df.columns, *total)


def _blocks(turns: DataFrame) -> DataFrame:
    """``conv_id, block, slice, t1..t8`` and the lanes ``k0..k3`` that name the prefix before the block."""
    rows = turns.select("conv_id", ((F.col("place") - 1) / BLOCK).cast("long").alias("block"), F.pmod(F.col("place") - 1, F.lit(BLOCK)).alias("at"), "turn_id")
    rows = rows.withColumn("slice", (F.col("block") / SLICE).cast("long")).repartition("conv_id", "slice")
    wide = rows.groupBy("conv_id", "slice", "block").agg(*[F.max(F.when(F.col("at") == j, F.col("turn_id"))).alias(f"t{j + 1}") for j in range(BLOCK)])
    own = _prefix_lanes(range(1, BLOCK + 1))
    summed = wide.select("*", *[x.alias(f"own_{k}") for k, x in zip(_LANES, own, strict=True)])
    named = _sums_before(summed, "conv_id", "slice", "block", {k: f"own_{k}" for k in _LANES})
    return named.select(
        "conv_id", "slice", "block", *[f"t{j + 1}" for j in range(BLOCK)], *[F.col(k).bitwiseAND(F.lit(_MASK)).alias(k) for k in _LANES],
        *[f"own_{k}" for k in _LANES],
    )


def _prefix_lanes(places) -> list[Column]:
    """Lane sums of the turns of a block that are there."""
    parts = [_mixed(F.col("block") * BLOCK + j, F.col(f"t{j}")) for j in places]
    there = [F.col(f"t{j}").isNotNull() for j in places]
    return [reduce(lambda x, y: x + y, [F.when(t, p[k]).otherwise(F.lit(0)) for t, p in zip(there, parts, strict=True)]) for k in range(4)]


def _rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """All prefixes that end in a block at once: ``node_a, node_b, up_a, up_b, depth, last`` and the measures of their members."""
    turns = ", ".join(f"t{j}" for j in range(1, BLOCK + 1))
    lanes = ", ".join(_LANES)
    rolled = blocks.sparkSession.sql(
        f"SELECT block, {lanes}, {turns}, grouping_id() AS gid, {measures} FROM {{blocks}} GROUP BY block, {lanes}, ROLLUP({turns})", blocks=blocks
    )
    rolled = rolled.withColumn("level", F.lit(BLOCK) - F.bit_count("gid"))
    there = reduce(lambda a, b: a + b, [F.col(f"t{j}").isNotNull().cast("int") for j in range(1, BLOCK + 1)])
    real = rolled.where((F.col("level") > 0) & (there == F.col("level")))  # a row that ends earlier has nulls at deeper levels
    last = F.element_at(F.array(*[f"t{j}" for j in range(1, BLOCK + 1)]), F.col("level"))
    real = real.withColumn("depth", F.col("block") * BLOCK + F.col("level")).withColumn("last", last)
    whole = [F.col(k) + x for k, x in zip(_LANES, _prefix_lanes(range(1, BLOCK + 1)), strict=True)]
    up = [x - y for x, y in zip(whole, _mixed(F.col("depth"), F.col("last")), strict=True)]
    (a, b), (c, d) = _name(whole), _name(up)
    dropped = ["block", "gid", "level", *_LANES, *[f"t{j}" for j in range(1, BLOCK + 1)]]
    return real.select("*", a.alias("node_a"), b.alias("node_b"), c.alias("up_a"), d.alias("up_b")).drop(*dropped)


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None) -> Trie:
    """All distinct prefixes of conversations, from the textless root on.

    ``turns`` has ``conv_id``, ``place`` (any order number, distinct within a conversation) and ``turn_id`` (of :func:`turn_id`); ``conversations`` lists
    all ``conv_id``, those without a turn included (by default those of ``turns``). Rows without a conversation id are left out.

    ``nodes``: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the node's
    subtree, members less one times the code points of the last text), ``turn_id`` of the last turn, and ``node_a, node_b``, which name a prefix. The
    node of least member c at depth d is the prefix of the first d turns of c.

    Turns are laid into rows of eight columns; a later row of a conversation carries the name of the prefix before it, so one ROLLUP
    covers all depths. A node's subtree is its members' chains of nodes that they are the least member of: a second ROLLUP sums
    the chains, less what the node's own chain has above it. No table gives no nodes.
    """
    turns = positions(turns.where("conv_id IS NOT NULL"), "conv_id", [F.col("place"), F.col("turn_id")], "place")
    if conversations is None:
        conversations = turns
    every = store(conversations.select("conv_id").where("conv_id IS NOT NULL").dropDuplicates(), "conversations")
    blocks = store(_blocks(turns), "turn-blocks")
    length = F.conv(F.hex(F.expr("substring(last, 17, 4)")), 16, 10).cast("long")
    nodes = _rolled(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id")
    nodes = store(nodes.select("*", ((F.col("n_convs") - 1) * length).alias("saved")), "prefixes")

    n_nodes = nodes.count()
    first, n_every = every.agg(F.min("conv_id"), F.count("*")).first()
    children = nodes.groupBy(F.col("up_a").alias("node_a"), F.col("up_b").alias("node_b")).agg(F.count("*").alias("n_children"))
    full = nodes.join(children, ["node_a", "node_b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    full = store(full, "prefixes-children")
    crowd = max(CROWD, n_nodes // 1000)
    up = full.select(F.col("node_a").alias("up_a"), F.col("node_b").alias("up_b"), F.col("conv_id").alias("above"), "n_children")
    crowded = up.where(F.col("n_children") > crowd).drop("n_children").withColumnRenamed("above", "far")
    fewer = up.where((F.col("n_children") > 0) & (F.col("n_children") <= crowd)).drop("n_children")
    marked = full.join(F.broadcast(crowded), ["up_a", "up_b"], "left")
    top = F.col("depth") == 1
    direct = marked.where(top | F.col("far").isNotNull()).withColumn("parent_conv_id", F.when(top, F.lit(first)).otherwise(F.col("far")))
    named = marked.where(~top & F.col("far").isNull()).join(fewer, ["up_a", "up_b"], "left").withColumnRenamed("above", "parent_conv_id")
    full = direct.unionByName(named, allowMissingColumns=True).drop("far", "up_a", "up_b")

    chained = full.withColumn("part", ((F.col("depth") - 1) / (BLOCK * SLICE)).cast("long"))
    chained = store(_sums_before(chained, "conv_id", "part", "depth", {"above_saved": "saved"}), "chains")
    leaf = (F.col("n_children") == 0).cast("long")
    sums = chained.groupBy("conv_id").agg(F.sum("saved").alias("own_saved"), F.sum(leaf).alias("own_leaf"), F.max("depth").alias("deepest"))
    sums = sums.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("deepest") - 1) / (BLOCK * SLICE)).cast("long")))).drop("deepest")
    trees = _rolled(blocks.join(sums, ["conv_id", "slice"]), "sum(own_saved) AS tree_saved, sum(own_leaf) AS n_leaves")
    trees = trees.select("node_a", "node_b", "tree_saved", "n_leaves")
    done = chained.join(trees, ["node_a", "node_b"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("tree_saved") - F.col("above_saved")).alias("saved_tokens"),
        F.col("last").alias("turn_id"), "node_a", "node_b",
    )
    root = chained.agg(
        F.coalesce(F.sum((F.col("depth") == 1).cast("long")), F.lit(0)).alias("n_children"),
        F.greatest(F.coalesce(F.sum(leaf), F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"),
    ).where(F.lit(n_every > 0))
    kind = dict(every.dtypes)["conv_id"]
    root = root.select(
        F.lit(first).cast(kind).alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast(kind).alias("parent_conv_id"),
        F.lit(n_every).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.lit(None).cast("binary").alias("turn_id"),
        F.lit(0).cast("long").alias("node_a"), F.lit(0).cast("long").alias("node_b"),
    )
    totals = blocks.groupBy("conv_id").agg(*[F.sum(F.col(f"own_{k}").bitwiseAND(F.lit(_MASK))).alias(k) for k in _LANES])
    a, b = _name([F.coalesce(F.col(k), F.lit(0).cast("long")) for k in _LANES])
    ends = every.join(totals, "conv_id", "left").select("conv_id", a.alias("node_a"), b.alias("node_b"))
    return Trie(done.unionByName(root), ends)


def conversation_trie(
    conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> Trie:
    """The trie of whole conversations; see :func:`numbered_turns` for their order and :func:`prefix_trie` for the result."""
    return prefix_trie(store(numbered_turns(conversations, id_column, turn_column, role_column, text_column), "turns"))


def end_digests(ends: DataFrame) -> DataFrame:
    """``node_a, node_b, ends_sha256``: SHA-256 of the ascending, comma-joined ids of the conversations that end at a node.

    Ids are joined in ranges of bounded size by many tasks; a digest is one chain over these strings, streamed by one task
    a node, which never holds more than a batch of them.
    """
    chunks = ends.groupBy("node_a", "node_b", F.shiftright(F.col("conv_id").cast("long"), CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list(F.col("conv_id").cast("long"))), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, chain, done = None, None, []
        batch_of = lambda rows: pa.record_batch(
            {
                "node_a": pa.array([r[0] for r in rows], pa.int64()),
                "node_b": pa.array([r[1] for r in rows], pa.int64()),
                "ends_sha256": pa.array([r[2] for r in rows], pa.string()),
            }
        )
        for batch in batches:
            for a, b, ids in zip(*(batch[c].to_pylist() for c in ("node_a", "node_b", "ids")), strict=True):
                if (a, b) == node:
                    chain.update(b"," + ids.encode())
                else:
                    if node is not None:
                        done.append((*node, chain.hexdigest()))
                    node, chain = (a, b), hashlib.sha256(ids.encode())
            yield batch_of(done)
            done = []
        if node is not None:
            yield batch_of([(*node, chain.hexdigest())])

    sorted_ = chunks.repartition("node_a", "node_b").sortWithinPartitions("node_a", "node_b", "chunk")
    return sorted_.mapInArrow(run, "node_a long, node_b long, ends_sha256 string")


def grafted(turns: DataFrame, span: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations that share their beginnings, and the list of all conversations.

    Conversation c takes its first h turns from conversation ``c - c % span``, as far as there are such, and keeps its own after the
    first h; h is the CRC-32 of c in decimal, modulo ``most``. ``turns`` is the result of :func:`numbered_turns`.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    first = F.col("conv_id") - F.col("conv_id") % span
    every = turns.where("place = 1").select("conv_id", first.alias("first"), h.alias("h"))
    heads = turns.where(((F.col("conv_id") % span) == 0) & (F.col("place") < most)).select(F.col("conv_id").alias("first"), "place", "turn_id")
    taken = every.join(heads, "first").where("place <= h").select("conv_id", "place", "turn_id")
    own = turns.where(F.col("place") > h).select("conv_id", "place", "turn_id")
    return taken.unionByName(own), every.select("conv_id")


def trie_digests(trie: Trie) -> DataFrame:
    """The nodes with the digest of the conversations that end there."""
    nodes = trie.nodes.join(end_digests(trie.ends), ["node_a", "node_b"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )
