"""Roles and turns of raw transcripts: a hidden Markov model over lines, then canonical turns.

States are (role, first or later line of a turn). Viterbi runs in blocks of lines: a block's effect is a matrix of best scores
between states, matrices multiply in the (max, +) sense, and blocks of a long conversation are combined in a tree, so
no task ever holds a whole conversation. Scores are integers, which makes the result independent of the blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.common import placed, store

ROLES = ("user", "assistant", "system")
#: Speaker names by role; fixed values.
SPEAKERS = {
    "user": ("user", "human", "customer", "question", "instruction"),
    "assistant": ("assistant", "ai", "bot", "answer", "response"),
    "system": ("system", "context"),
}
_NAMES = "|".join(n for names in SPEAKERS.values() for n in names)
#: A speaker name at the head of a line, in brackets or stars or after number signs, or followed by a colon or angle.
MARKER = rf"(?i)^\s*(?:\[({_NAMES})\]:?|<({_NAMES})>:?|\*\*({_NAMES}):?\*\*:?|#+\s*({_NAMES}):|({_NAMES})\s*[:>])[ \t]*"
STATES, START = 2 * len(ROLES), 2 * len(ROLES)
#: Sizes of the line features: marker (none, or a role), blank line at the row's start before it, question, length.
FEATURES = (len(ROLES) + 1, 2, 2, 4)
SYMBOLS = int(np.prod(FEATURES))
#: Lines of a block, and blocks that are combined at a time.
BLOCK = 256
SLOT_TURNS = 64
UNIT = 1_000_000
NEVER = -(10**15)


def transcript_lines(df: DataFrame, conversation: str, order: str, text: str, role: str | None = None) -> DataFrame:
    """``key, conversation, pos, source, lead, raw, cut, before, after, marker, symbol`` (and ``role``) of every line that is not blank.

    ``pos`` counts the lines of a conversation by ``order`` (ties by text); ``lead`` marks a row's first line; ``marker`` is the role that the
    line's speaker marker names, if it has one, and ``cut`` the length of that marker in ``raw``. ``before`` and ``after`` are the row's blank
    lines ahead of the line and, for the row's last line, behind it. A blank row that starts with a bare line break counts as a marked blank line.
    """
    conv = F.col(conversation)
    rows = df.select(
        F.when(conv.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), conv.cast("string"))).alias("key"),
        conv.alias("conversation"),
        F.col(order).cast("long").alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        (F.col(role).cast("string") if role else F.lit(None).cast("string")).alias("role"),
    )
    lines = rows.select("key", "conversation", "source", "role", F.xxhash64("text", "role").alias("tie"), F.split("text", "\r?\n").alias("all"))
    written = F.filter(F.transform("all", lambda x, i: F.when(F.trim(x) != "", i)), lambda i: i.isNotNull())
    bare = (F.size("all") > 1) & (F.get("all", F.lit(0)) == "")
    lines = lines.withColumn("at", written).withColumn("at", F.when((F.size("at") == 0) & bare, F.array(F.lit(1))).otherwise(F.col("at")))

    def piece(at: Column, k: Column) -> Column:
        past = F.coalesce(F.get("at", k - 1), F.lit(-1))
        last = k == F.size("at") - 1
        return F.struct(
            at.alias("at"), (k == 0).alias("lead"), F.get("all", at).alias("raw"), F.slice("all", past + 2, at - past - 1).alias("before"),
            F.when(last, F.slice("all", at + 2, F.size("all"))).otherwise(F.array().cast("array<string>")).alias("after"),
        )

    lines = lines.select("key", "conversation", "source", "role", "tie", F.inline(F.transform("at", piece)))
    blank = F.col("lead") & (F.size("before") > 0)  # blank lines inside a row part paragraphs and are no evidence
    name = F.lower(F.concat(*[F.regexp_extract("raw", MARKER, g) for g in range(1, 6)]))
    role_of = F.create_map(*[F.lit(x) for r, names in SPEAKERS.items() for n in names for x in (n, r)])
    lines = lines.withColumn("marker", role_of[name]).withColumn("line", F.regexp_replace("raw", MARKER, ""))
    lines = lines.withColumn("cut", F.length("raw") - F.length("line"))
    number = F.coalesce(F.create_map(*[F.lit(x) for i, r in enumerate(ROLES) for x in (r, i + 1)])[F.col("marker")], F.lit(0))
    length = F.length("line")
    size = F.when(length < 30, 0).when(length < 120, 1).when(length < 400, 2).otherwise(3)
    symbol = ((number * FEATURES[1] + blank.cast("int")) * FEATURES[2] + F.rtrim("line").endswith("?").cast("int")) * FEATURES[3] + size
    lines = lines.select("key", "conversation", "source", "role", "tie", "at", "lead", "marker", "raw", "cut", "before", "after", symbol.cast("int").alias("symbol"))
    lines = store(lines.withColumn("slot", F.floor(F.coalesce("source", F.lit(-1)) / SLOT_TURNS)), "lines")
    order_by = [F.asc_nulls_first("source"), F.col("tie"), F.col("at")]
    return store(placed(lines, ["key"], "slot", order_by, "pos").drop("slot", "tie"), "lines")


class ChatModel:
    """Integer log-probabilities: ``move[i, j]`` from state i (or ``START``) to j, ``emit[j, symbol]``."""

    def __init__(self, moves: np.ndarray | None = None, features: list[np.ndarray] | None = None):
        """From counts of moves (states + 1, states) and of feature values (states, size); both may be missing.

        Counts are smoothed with what turn taking and markers mean: a turn's later lines follow its lines, the other
        speaker follows, and a marker is nearly always true.
        """
        prior = np.zeros((STATES + 1, STATES))
        for i, a in enumerate(ROLES):
            for row in (2 * i, 2 * i + 1):
                prior[row, 2 * i + 1] = 4.0
                for j, b in enumerate(ROLES):
                    prior[row, 2 * j] = 0.05 if a == b else 0.2 if b == "system" else 1.0
            prior[START, 2 * i] = 0.2 if a == "assistant" else 1.0
        allowed = prior > 0
        total = prior + (moves if moves is not None else 0)
        self.move = self._scaled(np.where(allowed, total, 0))
        parts = []
        for f, size in enumerate(FEATURES):
            base = np.full((STATES, size), 0.5)
            if f == 0:
                base[:, 0], base[:, 1:] = 5.0, 0.01  # a marker is nearly always true
                for i in range(len(ROLES)):
                    base[2 * i, i + 1] = 5.0
            if f == 1:
                base[::2], base[1::2] = (4.0, 4.0), (5.0, 0.1)
            base = base + (features[f] if features is not None else 0)
            parts.append(np.log(base / base.sum(axis=1, keepdims=True)))
        index = np.stack(np.unravel_index(np.arange(SYMBOLS), FEATURES))
        self.emit = np.rint(UNIT * sum(p[:, i] for p, i in zip(parts, index, strict=True))).astype(np.int64)

    @staticmethod
    def _scaled(counts: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            log = np.log(counts / counts.sum(axis=1, keepdims=True))
        return np.where(np.isfinite(log), np.rint(UNIT * np.where(np.isfinite(log), log, 0)), NEVER).astype(np.int64)

    def line_matrices(self) -> np.ndarray:
        """For each symbol the scores from any state, start included, to any state; nothing leads to the start."""
        out = np.full((SYMBOLS, STATES + 1, STATES + 1), NEVER, np.int64)
        out[:, :, :STATES] = self.move[None] + self.emit.T[:, None, :]
        return out


def fit_chat_model(lines: DataFrame) -> ChatModel:
    """Counts over all lines whose ``role`` is known; the first line of a message begins a turn."""
    state = F.create_map(*[F.lit(x) for i, r in enumerate(ROLES) for x in (r, 2 * i)])[F.col("role")] + (~F.col("lead")).cast("int")
    known = lines.select("key", "pos", "symbol", state.alias("state")).where("state IS NOT NULL")
    after = known.select("key", (F.col("pos") + 1).alias("pos"), F.col("state").alias("from"))
    moves, features = np.zeros((STATES + 1, STATES)), [np.zeros((STATES, s)) for s in FEATURES]
    pairs = known.join(after, ["key", "pos"], "left").where("pos = 0 OR from IS NOT NULL")
    for r in pairs.groupBy(F.coalesce("from", F.lit(START)).alias("i"), F.col("state").alias("j")).count().collect():
        moves[r["i"], r["j"]] += r["count"]
    for r in known.groupBy("state", "symbol").count().collect():
        for f, v in zip(features, np.unravel_index(r["symbol"], FEATURES), strict=True):
            f[r["state"], v] += r["count"]
    return ChatModel(moves, features)


def _product(steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(max, +) products of sequences of matrices: ``steps`` is (rows, longest, S, S), of which ``lengths`` count."""
    out = steps[:, 0].copy()
    for t in range(1, steps.shape[1]):
        on = lengths > t
        out[on] = np.maximum((out[on][:, :, :, None] + steps[on, t][:, None, :, :]).max(axis=2), NEVER)
    return out


def _path(steps: np.ndarray, entry: int, leave: int) -> list[int]:
    """States after each step of the best way from ``entry`` to ``leave`` (or to the best end if that is -1)."""
    best, back = steps[0][entry], []
    for m in steps[1:]:
        through = best[:, None] + m
        back.append(through.argmax(axis=0))
        best = np.maximum(through.max(axis=0), NEVER)
    state = int(best.argmax()) if leave < 0 else leave
    out = [state]
    for pointers in reversed(back):
        state = int(pointers[state])
        out.append(state)
    return out[::-1]


def _padded(lists: pa.ListArray, matrices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.asarray(lists.offsets, np.int64)
    lengths = np.diff(offsets)
    grid = np.zeros((len(lengths), int(lengths.max(initial=1))), np.int64)
    grid[np.arange(grid.shape[1]) < lengths[:, None]] = np.asarray(lists.flatten())
    return matrices[grid], lengths


def viterbi_states(lines: DataFrame, model: ChatModel) -> DataFrame:
    """``key, pos, state`` of every line on the best path of its conversation."""
    table, flat = model.line_matrices(), (STATES + 1) ** 2

    def gathered(df: DataFrame, at: str, value: str) -> DataFrame:
        """Rows of one key in blocks of ``BLOCK``, in order."""
        ordered = F.sort_array(F.collect_list(F.struct(at, value)))
        return df.groupBy("key", F.floor(F.col(at) / BLOCK).alias("block")).agg(ordered.alias("rows")).select("key", "block", F.col(f"rows.{value}").alias("values"))

    def line_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                m = _product(*_padded(part["values"], table)).reshape(-1, flat)
                yield pa.record_batch({"key": part["key"], "block": part["block"], "m": pa.array(list(m), pa.list_(pa.int64()))})

    def block_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_product(np.array(v.as_py(), np.int64).reshape(1, -1, STATES + 1, STATES + 1), np.array([len(v)])).reshape(-1) for v in batch["values"]]
            yield pa.record_batch({"key": batch["key"], "block": batch["block"], "m": pa.array(found, pa.list_(pa.int64()))})

    def walk(steps_of):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                entry, leave = batch["entry"].to_pylist(), batch["leave"].to_pylist()
                found = [_path(steps_of(v), a, b) for v, a, b in zip(batch["values"], entry, leave, strict=True)]
                yield pa.record_batch({"key": batch["key"], "block": batch["block"], "entry": batch["entry"], "path": pa.array(found, pa.list_(pa.int32()))})

        return run

    of_symbols = walk(lambda v: table[np.asarray(v.values)])
    of_blocks = walk(lambda v: np.array(v.as_py(), np.int64).reshape(-1, STATES + 1, STATES + 1))
    path_schema, m_schema = "key string, block long, entry int, path array<int>", "key string, block long, m array<long>"
    blocks = store(gathered(lines.select("key", "pos", "symbol"), "pos", "symbol"), "line-blocks")
    several = blocks.where("block > 0").select("key").dropDuplicates()
    levels: list[DataFrame] = []
    m = store(blocks.join(several, "key", "left_semi").mapInArrow(line_products, m_schema), "block-matrices")
    while m.where("block > 0").limit(1).count():
        levels.append(store(gathered(m, "block", "m"), "matrix-blocks"))
        m = store(levels[-1].mapInArrow(block_products, m_schema), "block-matrices")
    ends = None  # entry and end state of each block of the level below
    for level in reversed(levels):
        if ends is None:
            here = level.select("*", F.lit(START).alias("entry"), F.lit(-1).alias("leave"))
        else:
            here = level.join(ends, ["key", "block"])
        walked = here.mapInArrow(of_blocks, path_schema)
        step = walked.select("key", "block", "entry", "path", F.posexplode("path").alias("i", "leave"))
        ends = store(step.select(
            "key", (F.col("block") * BLOCK + F.col("i")).alias("block"),
            F.when(F.col("i") == 0, F.col("entry")).otherwise(F.get("path", F.col("i") - 1)).alias("entry"), "leave",
        ), "block-ends")
    if ends is None:
        here = blocks.select("*", F.lit(START).alias("entry"), F.lit(-1).alias("leave"))
    else:
        here = blocks.join(ends, ["key", "block"], "left").select(
            "key", "block", "values", F.coalesce("entry", F.lit(START)).alias("entry"), F.coalesce("leave", F.lit(-1)).alias("leave")
        )
    walked = here.mapInArrow(of_symbols, path_schema).select("key", "block", F.posexplode("path").alias("i", "state"))
    return walked.select("key", (F.col("block") * BLOCK + F.col("i")).alias("pos"), "state")


def canonical_turns(
    df: DataFrame,
    model: ChatModel | None = None,
    conversation: str = "conv_id",
    order: str = "turn",
    text: str = "text",
) -> DataFrame:
    """One row per recovered turn: ``conv_id, turn`` (from 0), ``role, content, rendered, source_turn, n_lines``.

    Lines are read by ``order``; their speaker markers are evidence, not truth, and are cut off where a turn begins, nowhere else.
    ``source_turn`` is the ``order`` value of the turn's first line. ``rendered`` is ``<|role|>``, the content and ``<|end|>`` on lines of
    their own. ``n_lines`` counts the lines of the content.

    Blank lines belong to the turn that runs. One blank line right before a turn's first line is its separator and is cut; if it opens a
    row, it is the turn's marker, and further blank lines after it are the head of the turn unless a speaker marker follows.

    Null and blank texts have no lines and give no turn unless they carry a marker, which a bare line break at the start is, too. Rows with a null conversation are one
    conversation; a null order comes first; ties and repeated rows follow each other by a hash of their text. No rows give no
    rows.
    """
    lines = transcript_lines(df, conversation, order, text)
    states = viterbi_states(lines, model or ChatModel())
    told = lines.select("key", "conversation", "pos", "source", "lead", "raw", "cut", "before", "after", "marker").join(states, ["key", "pos"])
    told = store(told.withColumn("begins", (F.col("state") % 2 == 0).cast("long")).withColumn("block", F.floor(F.col("pos") / BLOCK)), "told")
    begun = told.groupBy("key", "block").agg(F.sum("begins").alias("n"))
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("key", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("key", "block").orderBy("pos")
    turned = told.join(begun, ["key", "block"]).withColumn("turn", F.col("earlier") + F.sum("begins").over(within) - 1)
    begins, none = F.col("begins") == 1, F.array().cast("array<string>")
    opened = begins & F.col("lead") & F.col("marker").isNull()  # by a blank line as marker, or by nothing
    head = F.when(~begins, F.col("before")).when(opened, F.slice("before", 2, F.size("before"))).otherwise(none)
    left = F.when(begins & ~opened & (F.size("before") > 1), F.slice("before", 1, F.size("before") - 1)).otherwise(none)
    line = F.when(begins, F.substr("raw", F.col("cut") + 1)).otherwise(F.col("raw"))
    own = F.struct(F.col("turn").alias("turn"), F.lit(1).alias("part"), F.concat(head, F.array(line), F.col("after")).alias("text"))
    running = F.struct((F.col("turn") - 1).alias("turn"), F.lit(0).alias("part"), left.alias("text"))
    parts = F.filter(F.array(own, running), lambda x: (F.size(x["text"]) > 0) & (x["turn"] >= 0))
    turned = turned.select("key", "pos", "state", "source", "conversation", F.inline(parts))
    first = F.min(F.struct("pos", "state", "source", "conversation"))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("pos", "part", "text"))), lambda x: x["text"])
    grouped = turned.groupBy("key", "turn").agg(
        first.alias("first"), F.array_join(F.flatten(texts), "\n").alias("content"), F.sum(F.size("text")).cast("long").alias("n_lines")
    )
    role = F.get(F.array(*[F.lit(r) for r in ROLES]), F.floor(F.col("first.state") / 2).cast("int"))
    return grouped.select(
        F.col("first.conversation").alias("conv_id"), "turn", role.alias("role"), "content",
        F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("content"), F.lit("\n<|end|>")).alias("rendered"),
        F.col("first.source").alias("source_turn"), "n_lines",
    )


def as_transcript(df: DataFrame, conversation: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Raw messages as chat exports write them: five marker styles, one of them a bare blank line.

    The style hangs on a hash of the conversation and the turn. Used to make transcripts of a table whose roles are known.
    """
    style = F.pmod(F.xxhash64(F.col(conversation), F.col(order), F.lit(3)), F.lit(5))
    name: Column = F.coalesce(F.col(role), F.lit("user"))
    other = F.coalesce(F.create_map(*[F.lit(x) for x in ("user", "Human", "assistant", "AI", "system", "Context")])[name], name)
    head = (
        F.when(style == 0, F.concat(F.initcap(name), F.lit(": ")))
        .when(style == 1, F.concat(other, F.lit(": ")))
        .when(style == 2, F.concat(F.lit("["), name, F.lit("] ")))
        .when(style == 3, F.concat(F.lit("**"), F.initcap(name), F.lit(":** ")))
        .otherwise(F.lit("\n"))
    )
    return df.withColumn(text, F.concat(head, F.coalesce(F.col(text), F.lit(""))))


def marker_of(line: str) -> str | None:
    """The speaker name that a line's marker holds."""
    found = re.match(MARKER, line)
    return next((g.lower() for g in found.groups() if g), None) if found else None
