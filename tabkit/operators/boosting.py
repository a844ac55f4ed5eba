"""Boosted trees of second order for numbers and any number of classes, with early stopping and exact Shapley values.

Rows are coded once into bins. Gradients and hessians are summed by (class, node, feature, bin), and the best cut of a node follows from these sums; they are kept in
fixed point, so trees do not depend on how rows are partitioned. A small table is boosted by one task. For a larger one all cores run one task each that keeps its rows
from the first round to the last, and tells the others its sums, or, if all tasks can hold all rows, the best cuts of its share of the features, by files of the shared folder. Where sums are too large for that,
executors come and go, or only Spark reaches the shared folder, coded rows are kept as Parquet in the shared folder and every level of a round is one job, whose reducers add the sums.
"""

from __future__ import annotations

import math
import os
import pickle
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabkit.errors import InsufficientDataError, ModelTrainingError
from tabkit.functions.columns import require_columns
from tabkit.plans.ordered import row_digest
from tabkit.session import scratch_path

ROUNDS = 200
#: Bins of a feature beside the one for missing values.
BINS = 255
#: Rounds between two writes of the rows' margins; in between tasks add the latest trees themselves.
SAVE_EVERY = 10
MAX_CLASSES = 1000
#: Coded rows of this size are held by one task, which saves a job per level, unless a level has more codes to count than a job is worth.
ONE_TASK_BYTES = 128 << 20
ONE_TASK_CODES = 40_000_000
#: Fewer training rows are dealt out to all cores before they are coded, as they may come from one file.
DEALT_ROWS = 4_000_000
#: Rows whose sums are taken at a time, and rows that go down a tree at a time.
SUMMED_ROWS, STEP_ROWS = 1 << 17, 1 << 15
#: Trees of at most so many nodes have a table from node and code to the next node.
TABLE_NODES = 512
#: From so many codes a level on, all cores keep rows and work side by side.
HELD_CODES = 5_000_000
#: Coded rows of this size may be held by every task at once.
COPIED_BYTES = 256 << 20
#: Bytes of sums of a level that tasks may send each other in all.
GATHERED_BYTES = 64 << 20
#: Rows that a task keeps beyond this size lie in files of its temporary folder, cut into pieces of ``FILE_BYTES``.
MEMORY_BYTES, FILE_BYTES = 256 << 20, 64 << 20
#: Features of few values are counted together while their values make at most so many pairs.
JOINT_CODES = 1 << 10
#: Gradients are summed as multiples of 2**-20.
_UNIT = float(1 << 20)
_ROWS = "n int, codes binary, y binary, weight binary, held binary, draw binary, margins binary"
_BEST = "tree int, node int, feature int, gain double, cut int, missing_left boolean, g_left double, h_left double, g double, h double"


@dataclass(frozen=True)
class Tree:
    """A binary tree by node number; children of a node follow its cut, missing values go where ``missing_left`` says."""

    feature: np.ndarray  # -1 at a leaf
    cut: np.ndarray  # codes up to it go left
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray  # sum of hessians of the training rows

    def next_nodes(self) -> np.ndarray:
        """Where a row at each node goes by its code; leaves lead to themselves."""
        code = np.arange(BINS + 1)
        left = np.where(code == 0, self.missing_left[:, None], code <= self.cut[:, None])
        inner = (self.feature >= 0)[:, None]
        return np.where(inner, np.where(left, self.left[:, None], self.right[:, None]), np.arange(len(self.feature))[:, None]).ravel()

    def down(self, codes: np.ndarray, node: np.ndarray, steps: int | None = None) -> np.ndarray:
        """Where rows at given nodes are after so many steps, or at the end. ``codes`` is a matrix of codes."""
        feature, out = np.maximum(self.feature, 0), np.empty(len(codes), np.int64)
        table = self.next_nodes() if len(feature) <= TABLE_NODES else None
        leaf = self.feature < 0
        for low in range(0, len(codes), STEP_ROWS):
            part, at = codes[low : low + STEP_ROWS], node[low : low + STEP_ROWS]
            rows, left = np.arange(len(part)), steps
            while left != 0 and not leaf[at].all():
                code = part[rows, feature[at]]
                if table is None:
                    lower = np.where(code == 0, self.missing_left[at], code <= self.cut[at])
                    at = np.where(leaf[at], at, np.where(lower, self.left[at], self.right[at]))
                else:
                    at = table[(at << 8) + code]
                left = left and left - 1
            out[low : low + STEP_ROWS] = at
        return out

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row of a matrix of codes."""
        return self.down(codes, np.zeros(len(codes), np.int64))


@dataclass(frozen=True)
class BoostedTrees:
    """Fitted trees, one per round and output; ``best_round`` rounds are used."""

    features: list[str]
    edges: list[np.ndarray]
    objective: str
    n_classes: int
    base: np.ndarray
    scale: float
    trees: list[list[Tree]]
    best_round: int
    curve: list[tuple[int, float, float | None]] = field(default_factory=list)

    @property
    def used(self) -> list[list[Tree]]:
        return self.trees[: self.best_round]


def _edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper limits of each feature's bins: its values, if they are few, else near-quantiles; one aggregation."""
    shares = [i / bins for i in range(1, bins)]
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    row = df.agg(*[F.percentile_approx(value(c), shares, 20 * bins).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], np.float64)) for i in range(len(features))]


def _code_matrix(batch: pa.RecordBatch, edges: Sequence[np.ndarray]) -> np.ndarray:
    codes = np.zeros((batch.num_rows, len(edges)), np.uint8)
    for i, e in enumerate(edges):
        x = np.asarray(batch[f"f{i}"].to_numpy(zero_copy_only=False), np.float64)
        codes[:, i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, side="left"))
    return codes


def _chance(margins: np.ndarray, objective: str) -> np.ndarray:
    if objective == "squared":
        return margins
    if objective == "logistic":
        return 1 / (1 + np.exp(-np.clip(margins, -500, 500)))
    odds = np.exp(margins - margins.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def _gradients(margins: np.ndarray, y: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    p = _chance(margins, objective)
    if objective == "squared":
        return p - y[:, None], np.ones_like(p)
    if objective == "logistic":
        return p - y[:, None], np.maximum(p * (1 - p), 1e-16)
    hit = np.arange(margins.shape[1])[None, :] == y[:, None]
    return p - hit, np.maximum(2 * p * (1 - p), 1e-16)


def _losses(margins: np.ndarray, y: np.ndarray, objective: str) -> np.ndarray:
    p = _chance(margins, objective)
    if objective == "squared":
        return (p[:, 0] - y) ** 2
    own = np.where(y == 1, p[:, 0], 1 - p[:, 0]) if objective == "logistic" else p[np.arange(len(y)), y.astype(np.int64)]
    return -np.log(np.clip(own, 1e-15, 1))


def _add(margins: np.ndarray, codes: np.ndarray, rounds: Sequence[Sequence[Tree]]) -> np.ndarray:
    for trees in rounds:
        margins = margins + np.column_stack([t.value[t.leaves(codes)] for t in trees])
    return margins


def _shares(draw: np.ndarray, step: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row and round, from the row's own hash."""
    x = draw.view(np.uint64) ^ np.uint64((step * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53


@dataclass(frozen=True)
class _Settings:
    objective: str
    width: int
    outputs: int
    scale: float
    rounds: int
    depth: int
    step: float
    l1: float
    l2: float
    gamma: float
    min_child: float
    row_share: float
    column_share: float
    patience: int | None
    seed: int


@dataclass
class _Rows:
    """Some rows in memory."""

    codes: np.ndarray
    margins: np.ndarray
    y: np.ndarray
    weight: np.ndarray
    held: np.ndarray
    draw: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, row: int, s: _Settings) -> _Rows:
        """The block of one row."""
        n = batch["n"][row].as_py()
        plain = lambda c, kind: np.frombuffer(batch[c][row].as_buffer(), kind)
        codes, margins = plain("codes", np.uint8).reshape(n, s.width), plain("margins", np.float64).reshape(n, s.outputs)
        return _Rows(codes, margins, plain("y", np.float64), plain("weight", np.float64), plain("held", bool), plain("draw", np.int64))

    @staticmethod
    def joined(parts: Sequence[_Rows]) -> _Rows:
        return _Rows(*(np.concatenate([getattr(p, c) for p in parts]) for c in _Rows.__dataclass_fields__))

    def block(self) -> pa.RecordBatch:
        values = {c: pa.array([np.ascontiguousarray(getattr(self, c)).tobytes()], pa.binary()) for c in ("codes", "y", "weight", "held", "draw", "margins")}
        return pa.record_batch({"n": pa.array([len(self.y)], pa.int32()), **values})


def _groups(batches: Iterator[pa.RecordBatch], s: _Settings) -> Iterator[_Rows]:
    """The rows of all blocks, some blocks at a time."""
    held: list[_Rows] = []
    for batch in batches:
        for row in range(batch.num_rows):
            held.append(_Rows.of(batch, row, s))
            if sum(len(p.y) for p in held) >= SUMMED_ROWS:
                yield _Rows.joined(held)
                held = []
    if held:
        yield _Rows.joined(held)


@dataclass
class _Round:
    """What a round needs of the rows it learns from: the same at every level."""

    use: np.ndarray
    codes: np.ndarray
    columns: np.ndarray  # the codes by feature
    gradient: np.ndarray
    hessian: np.ndarray
    nodes: list[np.ndarray]  # of each tree

    @staticmethod
    def of(rows: _Rows, number: int, s: _Settings) -> _Round:
        use = ~rows.held
        if s.row_share < 1:
            use &= _shares(rows.draw, number, s.seed) < s.row_share
        codes, weight = rows.codes[use], rows.weight[use][:, None]
        gradient, hessian = (np.ascontiguousarray(np.rint(x * weight * _UNIT).T) for x in _gradients(rows.margins[use], rows.y[use], s.objective))
        return _Round(use, codes, np.ascontiguousarray(codes.T), gradient, hessian, [np.zeros(len(codes), np.int64) for _ in range(s.outputs)])


def _lost(rows: _Rows, s: _Settings) -> np.ndarray:
    """Sums of losses and weights of the rows in training and of those held out."""
    loss = np.rint(_losses(rows.margins, rows.y, s.objective) * rows.weight * _UNIT)
    return np.array([x for part in (~rows.held, rows.held) for x in (loss[part].sum(), np.rint(rows.weight[part] * _UNIT).sum())]).astype(np.int64)


def _empty_sums(growing: list[Tree], first: list[int], columns: list[np.ndarray]) -> list[np.ndarray]:
    return [np.zeros((len(c), len(t.feature) - f, 2, BINS + 1), np.int64) for t, f, c in zip(growing, first, columns, strict=True)]


def _add_sums(total: list[np.ndarray], part: _Round, first: list[int], columns: list[np.ndarray]) -> None:
    """Adds for each tree the sums (feature, node, gradient or hessian, code) over nodes numbered ``first`` or higher."""
    for k, sums in enumerate(total):
        n = sums.shape[1]
        if not n:
            continue
        open_ = part.nodes[k] >= first[k]
        every = open_.all()
        base = (part.nodes[k] if every else part.nodes[k][open_]) - first[k]
        base *= BINS + 1
        values = [x[k] if every else x[k][open_] for x in (part.gradient, part.hessian)]
        for i, f in enumerate(columns[k]):
            place = base + (part.columns[f] if every else part.columns[f][open_])
            for j, x in enumerate(values):
                sums[i, :, j] += np.bincount(place, x, n * (BINS + 1)).astype(np.int64).reshape(n, BINS + 1)


def _level(rows: DataFrame, late: list[list[Tree]], growing: list[Tree], first: list[int], columns: list[np.ndarray], number: int, s: _Settings) -> DataFrame:
    """Best cut of every feature for every open node, over all rows; feature -1 tells the losses so far, at the first level."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, losses = _empty_sums(growing, first, columns), np.zeros(4, np.int64)
        for part in _groups(batches, s):
            part.margins = _add(part.margins, part.codes, late)
            if not any(first):
                losses += _lost(part, s)
            learnt = _Round.of(part, number, s)
            learnt.nodes = [t.leaves(learnt.codes) if f else n for t, f, n in zip(growing, first, learnt.nodes, strict=True)]
            _add_sums(total, learnt, first, columns)
        keys = [(k, int(f)) for k in range(len(growing)) for f in columns[k] if total[k].shape[1]]
        values = [x.tobytes() for t in total for x in t if t.shape[1]]
        if not any(first):
            keys, values = [*keys, (0, -1)], [*values, losses.tobytes()]
        names = ("tree", "feature")
        yield pa.record_batch({**{c: pa.array([x[i] for x in keys], pa.int32()) for i, c in enumerate(names)}, "sums": pa.array(values, pa.binary())})

    def best(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table["sums"]) / _UNIT
        tree, feature = (table[c][0].as_py() for c in ("tree", "feature"))
        if feature < 0:
            return _lines([[tree, 0, feature, 0.0, 0, False, *total.tolist()]])
        sides = total.reshape(-1, 2, BINS + 1)
        cuts = [x.tolist() for x in best_cuts(sides[:, 0], sides[:, 1], s.l1, s.l2, s.min_child)]
        return _lines([[tree, node, feature, *c] for node, c in enumerate(zip(*cuts, strict=True))])

    partial = rows.mapInArrow(sums, "tree int, feature int, sums binary")
    return partial.groupBy("tree", "feature").applyInArrow(best, _BEST)


def _lines(values: Sequence[Sequence]) -> pa.Table:
    names = [c.split()[0] for c in _BEST.split(", ")]
    kinds = {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in _BEST.split(", ")]
    return pa.table({n: pa.array(v, t) for n, t, v in zip(names, types, zip(*values, strict=True), strict=True)})


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def best_cuts(g: np.ndarray, h: np.ndarray, l1: float, l2: float, min_child: float) -> tuple[np.ndarray, ...]:
    """The cut with the highest gain for each row of sums by code (code 0 is missing).

    Gain is the loss that both children save over their parent, to second order. Of equal gains the lowest cut counts, missing values to the
    right first. Returns gain, cut, whether missing values go left, and the sums of the left side and of both; no allowed cut has gain 0.
    """
    all_g, all_h = g.sum(axis=1), h.sum(axis=1)
    score = lambda a, b: _shrunk(a, l1) ** 2 / (b + l2 + 1e-300)
    n = np.arange(len(g))
    top = [np.zeros(len(g)), np.zeros(len(g), np.int64), np.zeros(len(g), bool), np.zeros(len(g)), np.zeros(len(g))]
    for missing_left in (False, True):
        left_g, left_h = (np.cumsum(x[:, 1:], axis=1) + x[:, :1] * missing_left for x in (g, h))
        right_g, right_h = all_g[:, None] - left_g, all_h[:, None] - left_h
        allowed = (left_h >= min_child) & (right_h >= min_child) & (left_h > 0) & (right_h > 0)
        gain = np.where(allowed, score(left_g, left_h) + score(right_g, right_h) - score(all_g, all_h)[:, None], 0.0) / 2
        at = gain.argmax(axis=1)
        better = gain[n, at] > top[0] + 1e-9
        for k, x in enumerate((gain[n, at], at + 1, np.full(len(g), missing_left), left_g[n, at], left_h[n, at])):
            top[k] = np.where(better, x, top[k])
    return (*top, all_g, all_h)


def _grown(tree: Tree, first: int, lines: dict, s: _Settings) -> Tree:
    """The tree with the open nodes (numbered ``first`` or higher) cut where it gains, or closed."""
    parts = {n: list(getattr(tree, n)) for n in Tree.__dataclass_fields__}
    value = lambda g, h: float(-_shrunk(np.float64(g), s.l1) / (h + s.l2 + 1e-300) * s.step)
    for node in range(first, len(tree.feature)):
        found = lines.get(node - first)
        if found is None:
            continue
        if first == 0:
            parts["value"][0], parts["cover"][0] = value(found["g"], found["h"]), found["h"]
        if found["gain"] <= s.gamma + 1e-9:
            continue
        made = len(parts["feature"])
        parts["feature"][node], parts["cut"][node], parts["missing_left"][node] = found["feature"], found["cut"], found["missing_left"]
        parts["left"][node], parts["right"][node], parts["gain"][node] = made, made + 1, found["gain"]
        for g, h in ((found["g_left"], found["h_left"]), (found["g"] - found["g_left"], found["h"] - found["h_left"])):
            for n, v in (("feature", -1), ("cut", 0), ("missing_left", False), ("left", 0), ("right", 0), ("value", value(g, h)), ("gain", 0.0), ("cover", h)):
                parts[n].append(v)
    return Tree(**{n: np.array(v, getattr(tree, n).dtype) for n, v in parts.items()})


def _seedling() -> Tree:
    whole, real = np.zeros(1, np.int64), np.zeros(1)
    return Tree(whole - 1, whole, whole.astype(bool), whole, whole, real, real, real)


def fit_boosting(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    classes: int | None = None,
    validation: str | None = None,
    patience: int | None = None,
    rounds: int = ROUNDS,
    depth: int = 6,
    step: float = 0.3,
    l1: float = 0.0,
    l2: float = 1.0,
    gamma: float = 0.0,
    min_child: float = 1.0,
    row_share: float = 1.0,
    column_share: float = 1.0,
    positive_weight: float = 1.0,
    bins: int = BINS,
    seed: int = 42,
    start: BoostedTrees | None = None,
    one_task_bytes: int = ONE_TASK_BYTES,
) -> BoostedTrees:
    """Boosted trees for a number (``classes`` None), two classes, or more (labels 0, 1, ...; one tree per class and round).

    A round fits trees to first and second derivatives of the loss: squared, logistic or softmax. ``validation`` names a boolean column of rows
    that are held out; with ``patience`` boosting ends once their loss has not improved for so many rounds, and the best round counts. ``curve``
    has training and validation loss (log loss, or root mean squared error) after each round. ``start`` continues an earlier fit with its bins.

    Null and NaN features are missing and go, at each cut, to the side that gains more; rows with a missing label are left out. Features beyond 255
    distinct values are cut at near-quantiles. Equal rows draw equal shares of ``row_share``. Coded rows of at most ``one_task_bytes`` are boosted by one
    task, others by tasks side by side or one job per level, with the same trees.
    """
    require_columns(df, [*features, label])
    if classes is not None and not 2 <= classes <= MAX_CLASSES:
        raise ModelTrainingError(f"the number of classes must be 2 to {MAX_CLASSES}")
    if not 2 <= bins <= BINS:
        raise ValueError(f"bins must be 2 to {BINS}")
    y = F.col(label).cast("double")
    held = F.coalesce(F.col(validation).cast("boolean"), F.lit(False)) if validation else F.lit(False)
    known = df.where(y.isNotNull() & ~F.isnan(y))
    names = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    plain = known.select(*names, y.alias("y"), held.alias("held"), row_digest(known, seed).alias("digest"))
    train = plain.where(~F.col("held"))
    taught = F.when(~F.col("held"), F.col("y"))
    objective = "squared" if classes is None else "logistic" if classes == 2 else "softmax"
    seen = plain.agg(
        F.count("*").alias("all"), F.count(taught).alias("n"), F.avg(taught).alias("mean"), F.stddev_pop(taught).alias("sd"), F.min(taught).alias("lo"), F.max(taught).alias("hi"),
        F.min((taught == F.floor(taught)).cast("int")).alias("whole"),
    ).first()
    if not seen["n"]:
        raise InsufficientDataError("there is no training row with a label")
    if classes and (seen["lo"] < 0 or seen["hi"] >= classes or not seen["whole"]):
        raise ModelTrainingError(f"labels must be whole numbers from 0 to {classes - 1}")
    outputs = classes if objective == "softmax" else 1
    if start:
        edges, base, scale = start.edges, start.base, start.scale
        if start.features != list(features) or start.objective != objective or len(base) != outputs:
            raise ModelTrainingError("the earlier fit has other features or another objective")
    else:
        edges = _edges(train, [f"f{i}" for i in range(len(features))], bins)
        scale = float(seen["sd"]) or 1.0 if objective == "squared" else 1.0
        base = np.full(outputs, float(seen["mean"]) / scale if objective == "squared" else 0.0)
    spark, width = df.sparkSession, len(features)
    patience = patience if validation else None
    s = _Settings(objective, width, outputs, scale, rounds, depth, step, l1, l2, gamma, min_child, row_share, column_share, patience, seed)
    done: list[list[Tree]] = list(start.used) if start else []

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _code_matrix(batch, edges)
            margins = _add(np.tile(base, (len(codes), 1)), codes, done)
            y_ = batch["y"].to_numpy(zero_copy_only=False) / scale
            weight = np.where((objective == "logistic") & (y_ == 1), positive_weight, 1.0)
            held_, draw_ = (batch[c].to_numpy(zero_copy_only=False) for c in ("held", "draw"))
            yield _Rows(codes, margins, y_, weight, held_.astype(bool), draw_).block()

    draw = F.xxhash64("digest").alias("draw")
    ready = plain.select(*[f"f{i}" for i in range(width)], "y", "held", draw)
    n_rows, sizes = seen["all"], [len(e) + 2 for e in edges]
    n_bytes, n_codes = n_rows * (width + 8 * outputs + 25), n_rows * width * outputs
    folder = _shared_folder(spark) if n_codes >= HELD_CODES else None
    slots = _slots(spark) if folder else 0
    told = 16 * outputs * sum(sizes) << max(0, depth - 2)  # most sums of a level
    dealt = min(slots, math.isqrt(GATHERED_BYTES // told)) if told else 0
    copied = slots > 1 and n_bytes <= COPIED_BYTES
    if slots > 1 and (dealt == slots or not copied and 2 * dealt >= slots):
        trees, curve, best = _boost_side_by_side(ready.repartition(dealt), coded, len(done), sizes, s, folder, False)
    else:
        if seen["n"] <= DEALT_ROWS:
            ready = ready.repartition(spark.sparkContext.defaultParallelism)
        rows = _saved(ready.mapInArrow(coded, _ROWS))
        if copied:
            each = rows.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).repartitionById(slots, "task").drop("task")
            trees, curve, best = _boost_side_by_side(each, lambda batches: batches, len(done), sizes, s, folder, True)
        elif n_bytes <= one_task_bytes and n_codes <= ONE_TASK_CODES:
            trees, curve, best = _boost_in_task(rows, len(done), sizes, s)
        else:
            trees, curve, best = _boost_by_levels(rows, len(done), s)
    before = [c for c in start.curve if c[0] < len(done)] if start else []
    trees = [*done, *trees]
    return BoostedTrees(list(features), edges, objective, classes or 0, base, scale, trees, best if patience else len(trees), [*before, *curve])


Lines = tuple[list[dict[int, dict]], list[float]]
Fitted = tuple[list[list[Tree]], list[tuple[int, float, float | None]], int]


def _boost(level: Callable[..., Lines], finish: Callable[[list[Tree]], None], done: int, s: _Settings) -> Fitted:
    """The rounds: ``level`` finds the best cuts of open nodes over all rows, ``finish`` adds a round's trees to the rows' margins."""
    loss_of = lambda total, n: None if n == 0 else math.sqrt(total / n) * s.scale if s.objective == "squared" else total / n
    trees, curve, best, best_round = [], [], math.inf, done
    wanted = max(1, round(s.column_share * s.width))
    while True:
        number = done + len(trees) + 1
        columns = []
        for k in range(s.outputs):  # features of a tree are drawn by (seed, round, class)
            rng = np.random.default_rng([s.seed, number, k])
            columns.append(np.sort(rng.choice(s.width, wanted, replace=False)) if wanted < s.width else np.arange(s.width))
        growing, first = [_seedling() for _ in range(s.outputs)], [0] * s.outputs
        found, losses = level(growing, first, columns, number)
        curve.append((number - 1, *(loss_of(losses[k], losses[k + 1]) for k in (0, 2))))
        value = curve[-1][1] if curve[-1][2] is None else curve[-1][2]
        if value < best - 1e-12:
            best, best_round = value, number - 1
        if len(trees) >= s.rounds or (s.patience and number - 1 - best_round >= s.patience):
            return trees, curve, best_round
        for depth in range(s.depth):
            if depth:
                found, _ = level(growing, first, columns, number)
            sizes = [len(t.feature) for t in growing]
            growing = [_grown(t, f, lines, s) for t, f, lines in zip(growing, first, found, strict=True)]
            first = sizes
            if all(f == len(t.feature) for f, t in zip(first, growing, strict=True)):
                break
        trees.append(growing)
        finish(growing)


def _boost_by_levels(rows: DataFrame, done: int, s: _Settings) -> Fitted:
    """One job per level. Tasks add the latest rounds to the stored margins, which are written anew every ``SAVE_EVERY`` rounds."""
    state = {"rows": rows, "late": []}

    def finish(grown: list[Tree]) -> None:
        state["late"] = late = [*state["late"], grown]
        if len(late) < SAVE_EVERY:
            return

        def advanced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _groups(batches, s):
                part.margins = _add(part.margins, part.codes, late)
                yield part.block()

        state["rows"], state["late"] = _saved(state["rows"].mapInArrow(advanced, _ROWS)), []

    def level(growing: list[Tree], first: list[int], columns: list[np.ndarray], number: int) -> Lines:
        return _best_lines(_level(state["rows"], state["late"], growing, first, columns, number, s).collect(), s.outputs)

    return _boost(level, finish, done, s)


class _Space:
    """Arrays of a task: in memory at first, then in files that the system may put away."""

    def __init__(self, most: int):
        self.left, self.piece, self.at = most, np.empty(0, np.uint8), 0

    def kept(self, values: np.ndarray) -> np.ndarray:
        values = np.ascontiguousarray(values)
        self.left -= values.nbytes
        if self.left >= 0:
            return values
        size = -(-values.nbytes // 8) * 8
        if self.at + size > len(self.piece):
            with tempfile.TemporaryFile() as file:
                self.piece, self.at = np.memmap(file, np.uint8, "w+", shape=max(FILE_BYTES, size)), 0
        room = np.asarray(self.piece[self.at : self.at + values.nbytes]).view(values.dtype).reshape(values.shape)
        self.at += size
        room[...] = values
        return room


@dataclass
class _Chunk:
    """Some rows that a task keeps, and where they are in the trees that grow."""

    codes: np.ndarray  # row by row
    joint: list[np.ndarray | None]  # of each group of features, if it is counted here
    margins: np.ndarray
    y: np.ndarray
    weight: np.ndarray | None  # None: all one
    held: np.ndarray | None
    draw: np.ndarray | None
    mass: np.ndarray  # weights in training and held out
    gradient: np.ndarray  # by output; 0 for rows that the round does not use
    hessian: np.ndarray
    nodes: np.ndarray
    use: np.ndarray | None = None

    @staticmethod
    def of(rows: _Rows, joint: list[np.ndarray | None], s: _Settings, space: _Space) -> _Chunk:
        plain, held = bool((rows.weight == 1).all()), bool(rows.held.any())
        mass = np.array([np.rint(rows.weight[part] * _UNIT).sum() for part in (~rows.held, rows.held)])
        y = rows.y if s.objective == "squared" else rows.y.astype(np.uint16)
        state, kept = np.zeros((s.outputs, len(y))), space.kept
        return _Chunk(
            kept(rows.codes.ravel()), [None if x is None else kept(x) for x in joint], kept(rows.margins.copy()), kept(y), None if plain else kept(rows.weight),
            kept(rows.held) if held else None, kept(rows.draw) if s.row_share < 1 else None, mass, kept(state), kept(state.copy()), kept(state.astype(np.int32)),
        )

    def begin(self, number: int, s: _Settings) -> np.ndarray:
        """Gradients of a round, all rows at the roots. Returns sums of losses and weights in training and held out."""
        self.nodes[...] = 0
        self.use = None if self.held is None else ~self.held
        if self.draw is not None:
            drawn = _shares(self.draw, number, s.seed) < s.row_share
            self.use = drawn if self.use is None else self.use & drawn
        for out, x in zip((self.gradient, self.hessian), _gradients(self.margins, self.y, s.objective), strict=True):
            if self.weight is not None:
                x = x * self.weight[:, None]
            np.rint((x * _UNIT).T, out=out)
            if self.use is not None:
                out *= self.use
        loss = _losses(self.margins, self.y, s.objective)
        loss = np.rint((loss if self.weight is None else loss * self.weight) * _UNIT)
        late = 0.0 if self.held is None else loss[self.held].sum()
        return np.array([loss.sum() - late, self.mass[0], late, self.mass[1]]).astype(np.int64)

    def route(self, k: int, tree: Tree, low: int, high: int, width: int) -> None:
        """Rows at the nodes from ``low`` on, of ``high`` so far, go one level down."""
        feature = np.maximum(tree.feature[low:high], 0)
        code = np.arange(BINS + 1)
        left = np.where(code == 0, tree.missing_left[low:high, None], code <= tree.cut[low:high, None])
        inner = (tree.feature[low:high] >= 0)[:, None]
        table = np.where(inner, np.where(left, tree.left[low:high, None], tree.right[low:high, None]), np.arange(low, high)[:, None]).astype(np.int32).ravel()
        at = self.nodes[k]
        some = np.flatnonzero(at >= low) if (tree.feature[:low] < 0).any() else None
        node = np.subtract(at if some is None else at.take(some), low, dtype=np.int64)
        place = np.arange(0, len(self.codes), width) if some is None else some * width
        place += feature.take(node, mode="wrap")
        node <<= 8
        node += self.codes.take(place, mode="wrap")
        if some is None:
            table.take(node, mode="wrap", out=at)
        else:
            at[some] = table.take(node, mode="wrap")


def _grouped(sizes: Sequence[int], most: int) -> list[list[int]]:
    """Features in groups whose values make at most ``most`` pairs; a feature of more values is alone."""
    groups: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        fitting = next((g for g in groups if math.prod(sizes[i] for i in g) * sizes[f] <= most), None)
        if fitting is None:
            groups.append([f])
        else:
            fitting.append(f)
    return groups


class _Keeper:
    """Rows that one task keeps from the first round to the last.

    Of two nodes with one parent only the lighter is counted; the other has what is left of the parent's sums. ``tell`` gives what each of the tasks
    that work together has to say; with ``copies`` all of them hold the same rows and each counts its share of the features, otherwise each counts its own rows.
    """

    def __init__(self, blocks: Iterator[_Rows], sizes: Sequence[int], s: _Settings, me: int = 0, tasks: int = 1, copies: bool = False, tell: Callable[[bytes], list[bytes]] | None = None):
        self.s, self.sizes, self.copies, self.tell = s, sizes, copies, tell
        self.space, self.chunks = _Space(MEMORY_BYTES), []
        self.groups: list[list[int]] = []
        self.own: list[list[int]] = []
        self.me, self.tasks = me, tasks
        held: list[_Rows] = []
        for block in blocks:
            held.append(block)
            if sum(len(p.y) for p in held) >= SUMMED_ROWS:
                self._keep(_Rows.joined(held))
                held = []
        if held:
            self._keep(_Rows.joined(held))
        if not self.chunks:
            self._lay_out(0)

    def _lay_out(self, n: int) -> None:
        self.groups = _grouped(self.sizes, min(JOINT_CODES, n >> 7))
        units = [(k, g) for k in range(self.s.outputs) for g in range(len(self.groups))]
        if self.copies:
            units = units[len(units) * self.me // self.tasks : len(units) * (self.me + 1) // self.tasks]
        self.own = [[g for j, g in units if j == k] for k in range(self.s.outputs)]

    def _keep(self, rows: _Rows) -> None:
        if not self.chunks:
            self._lay_out(len(rows.y))
        used = {g for own in self.own for g in own}
        joint: list[np.ndarray | None] = []
        for g, members in enumerate(self.groups):
            code = None
            if g in used:
                code = rows.codes[:, members[0]]
                for f in members[1:]:
                    code = code.astype(np.uint16) * np.uint16(self.sizes[f]) + rows.codes[:, f]
            joint.append(code)
        self.chunks.append(_Chunk.of(rows, joint, self.s, self.space))

    def _count(self, chunk: _Chunk, k: int, pair: np.ndarray | None, n: int, totals: dict[tuple[int, int], np.ndarray]) -> None:
        """Adds the sums (pair of nodes, gradient or hessian, code) of a tree's groups; ``pair`` tells which nodes are counted."""
        values, base = (chunk.gradient[k], chunk.hessian[k]), None
        if pair is not None:
            base = pair.take(chunk.nodes[k], mode="wrap")
            counted = base >= 0
            if chunk.use is not None:
                counted &= chunk.use
            some = np.flatnonzero(counted)
            base, values = base.take(some), [x.take(some, mode="wrap") for x in values]
        for g in self.own[k]:
            if (k, g) not in totals:
                continue
            total, place = totals[k, g], chunk.joint[g]
            if base is not None:
                place = base * total.shape[2] + place.take(some, mode="wrap")
            for j, x in enumerate(values):
                total[:, j] += np.bincount(place, x, n * total.shape[2]).reshape(n, -1).astype(np.int64)

    def _advance(self, chunk: _Chunk, growing: list[Tree]) -> None:
        for k, tree in enumerate(growing):
            if len(tree.feature) > self.known[k]:
                chunk.route(k, tree, self.low[k], self.known[k], self.s.width)

    def level(self, growing: list[Tree], first: list[int], columns: list[np.ndarray], number: int) -> Lines:
        s, begins = self.s, not any(first)
        if begins:
            self.low, self.known, self.sums = [0] * s.outputs, [1] * s.outputs, [None] * s.outputs
        losses = np.zeros(4, np.int64)
        pairs: list[np.ndarray | None] = []  # by node; -1 is not counted
        lighter: list[np.ndarray | None] = []
        for tree, f in zip(growing, first, strict=True):
            right = None
            if not begins:
                cover = tree.cover[f:].reshape(-1, 2)
                right = (cover[:, 1] < cover[:, 0]).astype(np.int64)
            lighter.append(right)
            pairs.append(None if begins else np.full(len(tree.feature), -1))
            if not begins:
                pairs[-1][f + 2 * np.arange(len(right)) + right] = np.arange(len(right))
        counts = [1 if begins else len(x) for x in lighter]
        totals = {
            (k, g): np.zeros((n, 2, math.prod(self.sizes[f] for f in self.groups[g])), np.int64)
            for k, n in enumerate(counts) if n for g in self.own[k] if np.isin(self.groups[g], columns[k]).any()
        }
        for chunk in self.chunks:
            if begins:
                losses += chunk.begin(number, s)
            else:
                self._advance(chunk, growing)
            for k, n in enumerate(counts):
                if n:
                    self._count(chunk, k, pairs[k], n, totals)
        for k, tree in enumerate(growing):
            if not begins and len(tree.feature) > self.known[k]:
                self.low[k], self.known[k] = self.known[k], len(tree.feature)
        features = [[f for f in columns[k] if any(f in self.groups[g] for g in self.own[k])] for k in range(s.outputs)]
        small = {(k, int(f)): None for k, n in enumerate(counts) if n for f in features[k]}
        for (k, g), total in totals.items():
            members = self.groups[g]
            shaped = total.reshape(len(total), 2, *[self.sizes[f] for f in members])
            for i, f in enumerate(members):
                if (k, f) in small:
                    small[k, f] = shaped.sum(axis=tuple(2 + j for j in range(len(members)) if j != i))
        if self.tell and not self.copies:
            flat = sum(np.frombuffer(x, np.int64) for x in self.tell(np.concatenate([losses, *[x.ravel() for x in small.values()]]).tobytes()))
            losses, at = flat[:4], 4
            for key, x in small.items():
                small[key] = flat[at : at + x.size].reshape(x.shape)
                at += x.size
        found: list[dict[int, dict]] = []
        for k, n in enumerate(counts):
            found.append({})
            if not n or not features[k]:
                continue
            each = np.zeros((len(features[k]), n, 2, max(self.sizes)), np.int64)
            for i, f in enumerate(features[k]):
                each[i, :, :, : self.sizes[f]] = small[k, int(f)]
            if not begins:
                earlier = len(self.sums[k][0])
                parents = np.flatnonzero(growing[k].feature[first[k] - earlier : first[k]] >= 0)
                whole, at = np.empty((len(each), 2 * n, *each.shape[2:]), np.int64), 2 * np.arange(n)
                whole[:, at + lighter[k]] = each
                whole[:, at + 1 - lighter[k]] = self.sums[k][:, parents] - each
                each = whole
            self.sums[k] = each
            found[k] = _best_of(each, features[k], s)
        if self.tell and self.copies:
            merged: list[dict[int, dict]] = [{} for _ in found]
            for part in map(pickle.loads, self.tell(pickle.dumps(found))):
                for mine, other in zip(merged, part, strict=True):
                    for node, line in other.items():
                        if node not in mine or (line["gain"], -line["feature"]) > (mine[node]["gain"], -mine[node]["feature"]):
                            mine[node] = line
            found = merged
        return found, (losses / _UNIT).tolist() if begins else []

    def finish(self, grown: list[Tree]) -> None:
        for chunk in self.chunks:
            self._advance(chunk, grown)
            for k, tree in enumerate(grown):
                chunk.margins[:, k] += tree.value.take(chunk.nodes[k], mode="wrap")


def _best_of(sums: np.ndarray, features: Sequence[int], s: _Settings) -> dict[int, dict]:
    """The best cut of each node, from sums (feature, node, gradient or hessian, code); of equal gains the first feature."""
    names, shape = ("gain", "cut", "missing_left", "g_left", "h_left", "g", "h"), sums.shape[:2]
    g, h = (sums[:, :, j].reshape(-1, sums.shape[3]) / _UNIT for j in range(2))
    cuts = [x.reshape(shape) for x in best_cuts(g, h, s.l1, s.l2, s.min_child)]
    top, n = cuts[0].argmax(axis=0), np.arange(shape[1])
    lines = zip(*(x[top, n].tolist() for x in cuts), strict=True)
    return {i: {"feature": int(features[f]), **dict(zip(names, line, strict=True))} for i, (f, line) in enumerate(zip(top, lines, strict=True))}


def _boost_in_task(rows: DataFrame, done: int, sizes: Sequence[int], s: _Settings) -> Fitted:
    """The same rounds over rows that one task holds; sums are exact, so the trees are the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeper = _Keeper((_Rows.of(b, row, s) for b in batches for row in range(b.num_rows)), sizes, s)
        yield pa.record_batch({"fitted": pa.array([pickle.dumps(_boost(keeper.level, keeper.finish, done, s))], pa.binary())})

    return pickle.loads(rows.coalesce(1).mapInArrow(run, "fitted binary").first()["fitted"])


class _Talk:
    """What tasks of one barrier stage tell each other, by files of a folder that all of them reach; Spark's own exchange takes a second each time."""

    def __init__(self, folder: str, context: BarrierTaskContext):
        self.me, self.tasks, self.step = context.partitionId(), len(context.getTaskInfos()), 0
        self.folder = os.path.join(folder, context.allGather(uuid.uuid4().hex)[0])  # another one if the stage is repeated
        os.makedirs(self.folder, exist_ok=True)
        self._say(b"")
        context.barrier()
        if not all(os.path.exists(self._path(i)) for i in range(self.tasks)):
            raise RuntimeError(f"{folder} is not shared by all executors")

    def _path(self, task: int, step: int | None = None) -> str:
        return os.path.join(self.folder, f"{self.step if step is None else step}-{task}")

    def _say(self, said: bytes) -> None:
        path = self._path(self.me)
        with open(f"{path}.part", "wb") as f:
            f.write(said)
        os.rename(f"{path}.part", path)

    def __call__(self, said: bytes) -> list[bytes]:
        """What every task says. Who has told something has heard all that was told before, so that this can be deleted."""
        self.step += 1
        self._say(said)
        heard = []
        for task in range(self.tasks):
            path, pause = self._path(task), 0.0002
            while not os.path.exists(path):
                time.sleep(pause)
                pause = min(1.3 * pause, 0.002)
            with open(path, "rb") as f:
                heard.append(f.read())
        os.unlink(self._path(self.me, self.step - 1))
        return heard


def _boost_side_by_side(rows: DataFrame, blocks_of: Callable, done: int, sizes: Sequence[int], s: _Settings, folder: str, copies: bool) -> Fitted:
    """The same rounds by tasks that run at the same time, one for each partition of ``rows``; all of them grow the same trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (_Rows.of(b, row, s) for b in blocks_of(batches) for row in range(b.num_rows))
        talk = _Talk(folder, BarrierTaskContext.get())
        keeper = _Keeper(blocks, sizes, s, talk.me, talk.tasks, copies, talk)
        fitted = _boost(keeper.level, keeper.finish, done, s)
        if not talk.me:
            yield pa.record_batch({"fitted": pa.array([pickle.dumps(fitted)], pa.binary())})

    return pickle.loads(rows.mapInArrow(run, "fitted binary", barrier=True).collect()[0]["fitted"])


def _shared_folder(spark: SparkSession) -> str | None:
    """A new folder that tasks can write to by themselves, unless the shared one is in a store that only Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "boosting"))
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        return None
    return path.toUri().getPath()


def _slots(spark: SparkSession) -> int:
    """Tasks that can run at the same time; none if executors come and go, as tasks that wait for each other need all of theirs."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def _saved(rows: DataFrame) -> DataFrame:
    path = scratch_path(rows.sparkSession, "boosting")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(_ROWS).parquet(path)


def _best_lines(lines: Sequence, outputs: int) -> Lines:
    """The best line of each node of each tree (of equal gains the first feature), and the losses if a line tells them."""
    found: list[dict[int, dict]] = [{} for _ in range(outputs)]
    losses: list[float] = []
    for row in lines:
        if row["feature"] < 0:
            losses = [row["g_left"], row["h_left"], row["g"], row["h"]]
            continue
        other = found[row["tree"]].get(row["node"])
        if other is None or (row["gain"], -row["feature"]) > (other["gain"], -other["feature"]):
            found[row["tree"]][row["node"]] = row
    return found, losses


def _with_margins(df: DataFrame, model: BoostedTrees, column: str) -> DataFrame:
    """``df`` with the margins of every row as an array column."""
    names = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(model.features)]
    outputs = len(model.base)

    @F.pandas_udf("array<double>")
    def margins(frame: pd.DataFrame) -> pd.Series:
        codes = _code_matrix(pa.RecordBatch.from_pandas(frame, preserve_index=False), model.edges)
        return pd.Series(list(_add(np.tile(model.base, (len(codes), 1)), codes, model.used) * model.scale), dtype=object)

    return df.withColumn(column, margins(F.struct(*names)) if names else F.array(*[F.lit(float(b)) for b in model.base[:outputs]]))


def predict(df: DataFrame, model: BoostedTrees, column: str = "prediction", probability: str | None = None) -> DataFrame:
    """``df`` with the predicted number, or the likeliest class (of equals the first) and, if named, the probability of every class."""
    out = _with_margins(df, model, "__margins")
    m = F.col("__margins")
    if model.objective == "squared":
        return out.withColumn(column, m[0]).drop("__margins")
    if model.objective == "logistic":
        p = 1 / (1 + F.exp(-m[0]))
        chances = F.array(1 - p, p)
    else:
        odds = F.transform(m, lambda x: F.exp(x - F.array_max(m)))
        chances = F.transform(odds, lambda x: x / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))
    if probability:
        out = out.withColumn(probability, chances)
    return out.withColumn(column, (F.array_position(m, F.array_max(m)) - 1).cast("double") if model.objective == "softmax" else (m[0] > 0).cast("double")).drop("__margins")


def importances(model: BoostedTrees) -> list[tuple[str, float]]:
    """Share of every feature in the gain of all cuts."""
    total = np.zeros(len(model.features))
    for trees in model.used:
        for t in trees:
            inner = t.feature >= 0
            np.add.at(total, t.feature[inner], t.gain[inner])
    return list(zip(model.features, (total / (total.sum() or 1.0)).tolist(), strict=True))


def learning_curve(spark: SparkSession, model: BoostedTrees) -> DataFrame:
    """``round, train_loss, validation_loss, is_best`` of every round."""
    rows = [(r, a, b, r == model.best_round) for r, a, b in model.curve]
    return spark.createDataFrame(rows, "round int, train_loss double, validation_loss double, is_best boolean")


@dataclass(frozen=True)
class _Path:
    """The way to a leaf: for each feature on it the codes that stay on it, and how many of the training rows do."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    missing: np.ndarray
    cover: np.ndarray
    value: float


def leaf_paths(tree: Tree) -> list[_Path]:
    """All ways from the root to a leaf; a feature that is cut several times is one interval of codes with one share of cover."""
    found = []
    stack = [(0, {})]
    while stack:
        node, way = stack.pop()
        f = int(tree.feature[node])
        if f < 0:
            parts = [(k, *v) for k, v in sorted(way.items())]
            columns = list(zip(*parts, strict=True)) if parts else [[]] * 5
            found.append(_Path(*(np.array(c, t) for c, t in zip(columns, (np.int64, np.int64, np.int64, bool, float), strict=True)), float(tree.value[node])))
            continue
        low, high, missing, cover = way.get(f, (1, BINS + 1, True, 1.0))
        for child, a, b, m in (
            (int(tree.left[node]), low, min(high, int(tree.cut[node])), bool(tree.missing_left[node])),
            (int(tree.right[node]), max(low, int(tree.cut[node]) + 1), high, not tree.missing_left[node]),
        ):
            share = float(tree.cover[child] / tree.cover[node]) if tree.cover[node] > 0 else 0.0
            stack.append((child, {**way, f: (a, b, missing and m, cover * share)}))
    return found


def _subset_weights(n: int) -> np.ndarray:
    """Shapley weight of a subset of each size of the other n - 1 players."""
    return np.array([math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) for k in range(n)])


def path_values(path: _Path, codes: np.ndarray, width: int) -> np.ndarray:
    """Shapley values that one leaf gives each row: (rows, width).

    A coalition that holds a feature keeps the leaf if the row's code is in its interval; one without it keeps the feature's share of cover. So a
    coalition's value is a product over the path's features, and the sum over coalitions by size is a polynomial: the product of
    (cover + inside * z), with one factor taken out for the feature in question. Rows that are inside the same intervals have the same values, so these
    are computed once for each set of intervals if there are more rows than sets.
    """
    out = np.zeros((len(codes), width))
    n = len(path.features)
    if not n:
        return out
    if 1 << n < len(codes):
        sets = np.arange(1 << n)
        own, code = np.zeros(len(codes), np.int64), np.arange(BINS + 1)
        for j, f in enumerate(path.features):
            stays = np.where(code == 0, path.missing[j], (code >= path.low[j]) & (code <= path.high[j]))
            own += (stays.astype(np.int64) << j).take(codes[:, f])
        out[:, path.features] = _set_values(path, (sets[:, None] >> np.arange(n) & 1).astype(float)).take(own, axis=0)
        return out
    own = codes[:, path.features]
    out[:, path.features] = _set_values(path, np.where(own == 0, path.missing, (own >= path.low) & (own <= path.high)).astype(float))
    return out


def _set_values(path: _Path, inside: np.ndarray) -> np.ndarray:
    """Shapley values of the path's features, by whether a row is inside their intervals."""
    n = len(path.features)
    out = np.empty(inside.shape)
    weights = _subset_weights(n)
    for j in range(n):
        poly = np.zeros((len(inside), n))
        poly[:, 0] = 1.0
        for i in range(n):
            if i != j:
                poly[:, 1:] = poly[:, 1:] * path.cover[i] + poly[:, :-1] * inside[:, i : i + 1]
                poly[:, 0] *= path.cover[i]
        out[:, j] = (poly @ weights) * (inside[:, j] - path.cover[j]) * path.value
    return out


def mean_margin(model: BoostedTrees, output: int) -> float:
    """What the model gives when no feature is known: every leaf by its share of cover."""
    return model.scale * (model.base[output] + sum(p.value * float(np.prod(p.cover)) for trees in model.used for p in leaf_paths(trees[output])))


def tree_shap(df: DataFrame, model: BoostedTrees, output: int = -1) -> DataFrame:
    """``df`` with ``shap`` (exact Shapley values of every feature, in margin units), ``margin`` and ``mean_margin``.

    Features outside of a coalition are averaged over the training rows of each node. The values of a row sum to ``margin - mean_margin``. ``output`` is the
    class explained, by default the last. Rows are explained one by one, in as many tasks as ``df`` has.
    """
    width, outputs = len(model.features), len(model.base)
    output %= outputs
    trees = [t[output] for t in model.used]
    centre = mean_margin(model, output)

    @F.pandas_udf("struct<shap: array<double>, margin: double>")
    def explained(frame: pd.DataFrame) -> pd.DataFrame:
        codes = _code_matrix(pa.RecordBatch.from_pandas(frame, preserve_index=False), model.edges)
        values, margin = np.zeros((len(codes), width)), np.full(len(codes), model.base[output])
        for tree in trees:
            margin += tree.value[tree.leaves(codes)]
            for path in leaf_paths(tree):
                values += path_values(path, codes, width)
        return pd.DataFrame({"shap": list(values * model.scale), "margin": margin * model.scale})

    names = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(model.features)]
    return df.withColumn("__e", explained(F.struct(*names))).select(
        "*", F.col("__e.shap").alias("shap"), F.col("__e.margin").alias("margin"), F.lit(centre).alias("mean_margin")
    ).drop("__e")


class VectorBoosting:
    """Boosting over a vector column, with ``fit`` and ``transform`` as other estimators have them."""

    def __init__(self, classes: int | None = None, label: str = "label", column: str = "features", **settings):
        self.classes, self.label, self.column, self.settings = classes, label, column, settings

    def fit(self, train: DataFrame) -> VectorBoosted:
        row = train.select(self.column).first()
        if row is None:
            raise InsufficientDataError("there is no training row")
        names = [f"x{i}" for i in range(row[0].size)]
        values = vector_to_array(self.column)
        extra = [c for c in (self.settings.get("validation"),) if c]
        wide = train.select(self.label, *extra, *[values[i].alias(n) for i, n in enumerate(names)])
        return VectorBoosted(fit_boosting(wide, names, self.label, self.classes, **self.settings), self.column)


class VectorBoosted:
    """Boosted trees that read a vector column."""

    def __init__(self, model: BoostedTrees, column: str = "features"):
        self.model, self.column = model, column

    def _wide(self, df: DataFrame) -> DataFrame:
        values = vector_to_array(self.column)
        return df.select("*", *[values[i].alias(n) for i, n in enumerate(self.model.features)])

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` and, for classes, a vector of probabilities."""
        found = predict(self._wide(df), self.model, probability=None if self.model.objective == "squared" else "__p")
        found = found.drop(*self.model.features)
        return found if self.model.objective == "squared" else found.withColumn("probability", array_to_vector("__p")).drop("__p")

    @property
    def importances(self) -> list[float]:
        return [v for _, v in importances(self.model)]


def forest_trees(forest: Model, path: str) -> BoostedTrees:
    """A fitted random forest of ``pyspark.ml`` in the form of :class:`BoostedTrees`, so that its Shapley values are exact too.

    The forest is written to ``path`` and its node table read back. The margin is the mean prediction of the trees, for a
    classifier the mean share of the last class.
    """
    forest.write().overwrite().save(path)
    spark = SparkSession.active()
    nodes = spark.read.parquet(f"{path}/data")
    tree = "treeID" if "treeID" in nodes.columns else "treeId"
    rows = nodes.select(F.col(tree).alias("tree"), "nodeData.*").select(
        "tree", "id", "prediction", "impurityStats", "gain", "leftChild", "rightChild", "rawCount",
        F.col("split.featureIndex").alias("feature"), F.col("split.leftCategoriesOrThreshold")[0].alias("threshold"), F.col("split.numCategories").alias("kinds"),
    ).orderBy("tree", "id").collect()
    if any(r["leftChild"] >= 0 and r["kinds"] >= 0 for r in rows):
        raise ModelTrainingError("only forests over numeric features can be explained")
    width, classes = forest.numFeatures, getattr(forest, "numClasses", 0)
    edges = [np.unique([r["threshold"] for r in rows if r["leftChild"] >= 0 and r["feature"] == f]) for f in range(width)]
    if max((len(e) for e in edges), default=0) > BINS:
        raise ModelTrainingError(f"a feature has more than {BINS} thresholds; fit the forest with fewer bins")
    grown: dict[int, list] = {}
    for r in rows:
        grown.setdefault(r["tree"], []).append(r)
    trees = []
    for members in grown.values():
        at = {r["id"]: i for i, r in enumerate(members)}
        inner = [r["leftChild"] >= 0 for r in members]
        share = lambda r: r["impurityStats"][-1] / (sum(r["impurityStats"]) or 1.0) if classes else r["prediction"]
        column = lambda f, kind: np.array([f(r) if i else 0 for r, i in zip(members, inner, strict=True)], kind)  # noqa: E731, B023
        trees.append(
            Tree(
                np.where(inner, column(lambda r: r["feature"], np.int64), -1),
                column(lambda r: 1 + np.searchsorted(edges[r["feature"]], r["threshold"]), np.int64),
                np.zeros(len(members), bool),
                column(lambda r: at[r["leftChild"]], np.int64),  # noqa: B023
                column(lambda r: at[r["rightChild"]], np.int64),  # noqa: B023
                np.array([share(r) / len(grown) for r in members]),
                column(lambda r: max(r["gain"], 0.0), np.float64),
                np.array([float(sum(r["impurityStats"])) if classes else float(r["impurityStats"][0]) for r in members]),
            )
        )
    return BoostedTrees([f"x{i}" for i in range(width)], edges, "squared", classes, np.zeros(1), 1.0, [[t] for t in trees], len(trees))
