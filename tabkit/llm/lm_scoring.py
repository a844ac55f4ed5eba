"""Log-likelihood of whole documents under a gated recurrent language model learned from the corpus.

The vocabulary is open: frequent words are predicted one by one in classes of equal size, all others through classes
that share an ending, with add-one counts inside. Counts cover every training token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.bpe import text_chunks
from tabkit.llm.common import id_remainder, store

#: Words that the network predicts one by one, in classes of ``CLASS_WORDS``.
HEAD_WORDS, CLASS_WORDS = 512, 32
#: Classes of the other words: one for each of the commonest endings, one for the rest.
ENDING_LETTERS, ENDINGS = 3, 23
#: Words whose counts are sent to every task; the others get theirs by a join. Words of equal count are chosen by one of so many hashes.
SHARED_WORDS, HASH_GRADES = 131_072, 4096
HIDDEN = 16
#: Training: parallel streams, steps of truncated backpropagation, passes between averages.
STREAMS, STEPS, ROUNDS = 256, 16, 4
RATE = 0.1
#: Scoring: steps of a window; the state goes on from window to window.
SCORE_STEPS = 32
COUNT_BYTES, TRAIN_BYTES, SCORE_BYTES = 12 << 20, 16 << 20, 10 << 20
#: Weights stay within this range; states are within (-1, 1), so that exponentials cannot overflow.
LARGEST = 4.0
#: Weights averaged by one task.
FAN_IN = 32
END = ""  # no word is empty, so this stands for the end of a text


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Dictionary-coded words of all texts in a row (A-Z lower-cased, cut at ASCII white space), and text offsets."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat = lists.flatten()
    offsets = np.asarray(lists.offsets, np.int64)
    offsets = offsets - offsets[0]
    full = np.asarray(pc.binary_length(flat)) > 0
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    return flat.dictionary_encode(), offsets


def count_words(df: DataFrame) -> DataFrame:
    """``word, n`` over all rows of ``text``; each text adds one end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", COUNT_BYTES):
                coded, _ = split_words(chunk["text"])
                n = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary))
                words = pa.concat_arrays([coded.dictionary, pa.array([END], coded.dictionary.type)])
                yield pa.record_batch({"word": words.cast(pa.string()), "n": pa.array(np.append(n, chunk.num_rows), pa.int64())})

    return df.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Frequent words with their counts, and how every other word falls into a class."""

    words: list[str]  # by decreasing count
    counts: np.ndarray
    endings: list[str]
    total: int  # training tokens
    distinct: int
    tail_total: np.ndarray  # of each ending class
    tail_distinct: np.ndarray
    number: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.head = min(HEAD_WORDS, len(self.words))
        self.head_classes = -(-self.head // CLASS_WORDS)
        self.classes = self.head_classes + len(self.endings) + 1
        self.inputs = self.head + len(self.endings) + 1
        self.number = {w: i for i, w in enumerate(self.words)}
        self.known_words, self.known_endings = pa.array(self.words, pa.string()), pa.array(self.endings, pa.string())

    def of_network(self) -> Vocabulary:
        """What the network needs: the same inputs, without the ranks of words that it does not predict one by one."""
        return replace(self, words=self.words[: self.head], counts=self.counts[: self.head], number={})

    def codes(self, words: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each word among the shared ones (or -1), and its network input: a head word or an ending class."""
        words = words.cast(pa.string()) if isinstance(words, pa.Array) else pa.array(words, pa.string())
        found = lambda values, among, other: np.asarray(pc.fill_null(pc.index_in(values, value_set=among), other), np.int64)
        rank = found(words, self.known_words, -1)
        tail = found(pc.utf8_slice_codeunits(words, -ENDING_LETTERS), self.known_endings, len(self.endings))
        return rank, np.where((rank >= 0) & (rank < self.head), rank, self.head + tail)


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    """From stored word counts; the driver gets at most ``SHARED_WORDS`` words and the end.

    Words come by grades of their count, the highest first; of the grade that does not fit as a whole, by grades of their hash.
    """
    sizes = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).first()
    grade, part = F.floor(F.log2("n") * 16), F.pmod(F.xxhash64("word"), F.lit(HASH_GRADES))
    room, wanted = SHARED_WORDS, F.col("word") == END
    for r in counts.groupBy(grade.alias("grade")).count().orderBy(F.desc("grade")).collect():
        if r["count"] > room:
            parts = counts.where(grade == r["grade"]).groupBy(part.alias("part")).count().orderBy("part").collect()
            fits = np.cumsum([p["count"] for p in parts]) <= room
            wanted = wanted | (grade > r["grade"]) | ((grade == r["grade"]) & (part < parts[int(fits.sum())]["part"]))
            break
        room -= r["count"]
    else:
        wanted = F.lit(True)  # all words fit
    rows = sorted(counts.where(wanted).collect(), key=lambda r: (-r["n"], r["word"]))
    common: dict[str, int] = {}
    for r in rows[HEAD_WORDS:]:
        end = r["word"][-ENDING_LETTERS:]
        common[end] = common.get(end, 0) + r["n"]
    endings = sorted(common, key=lambda e: (-common[e], e))[:ENDINGS]
    head = [r["word"] for r in rows[:HEAD_WORDS]]
    numbers = F.create_map(*[x for i, e in enumerate(endings) for x in (F.lit(e), F.lit(i))]) if endings else None
    of_word = F.coalesce(numbers[F.right(F.col("word"), F.lit(ENDING_LETTERS))], F.lit(len(endings))) if endings else F.lit(0)
    tail = counts.where(~F.col("word").isin(head)) if head else counts
    sums = tail.groupBy(of_word.alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tail_total, tail_distinct = np.zeros(len(endings) + 1), np.zeros(len(endings) + 1)
    for r in sums:
        tail_total[r["class"]], tail_distinct[r["class"]] = r["n"], r["v"]
    return Vocabulary([r["word"] for r in rows], np.array([r["n"] for r in rows], np.int64), endings, sizes["total"], sizes["distinct"], tail_total, tail_distinct)


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place: like the hyperbolic tangent, without exponentials. Its slope is (1 - |result|) squared."""
    size = np.abs(x)
    size += 1
    x /= size
    return x


def _gate_slope(gate: np.ndarray) -> np.ndarray:
    slope = 2 * gate
    slope -= 1
    np.abs(slope, out=slope)
    np.subtract(1, slope, out=slope)
    slope *= slope
    slope *= 0.5
    return slope


class GatedModel:
    """Gated recurrent unit with a class-factored softmax, in numpy.

    Parameters: ``enter`` (input word to the three gates), ``turn`` (state to gates), ``to_class``, ``class_bias``,
    and for the words of each head class ``to_word``, ``word_bias``. Biases start from the counts, so an
    untrained model is the unigram model.
    """

    NAMES = ("enter", "turn", "to_class", "class_bias", "to_word", "word_bias")

    def __init__(self, vocabulary: Vocabulary, seed: int = 5):
        v, rng = vocabulary, np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.head, self.head_classes = v.head, v.head_classes
        self.enter, self.turn = small(v.inputs, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN)
        self.to_class, self.to_word = small(HIDDEN, v.classes), small(max(1, v.head_classes), HIDDEN, CLASS_WORDS)
        n = np.zeros((max(1, v.head_classes), CLASS_WORDS))
        n.reshape(-1)[: v.head] = v.counts[: v.head]
        mass = np.concatenate([n.sum(axis=1)[: v.head_classes], v.tail_total]) + 1
        self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.word_bias = np.maximum(np.log(n / n.sum(axis=1, keepdims=True)), -1e9).astype(np.float32)
        self.word_bias[np.isnan(self.word_bias)] = 0.0

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def packed(self) -> bytes:
        return b"".join(p.astype(np.float32).tobytes() for p in self.parameters())

    def unpack(self, raw: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            p = getattr(self, n)
            setattr(self, n, raw[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size

    @staticmethod
    def by_gate(rows: np.ndarray) -> np.ndarray:
        """Rows of the three gates as a table for each gate, so that a gate's values lie side by side."""
        return np.ascontiguousarray(rows.reshape(len(rows), 3, HIDDEN).transpose(1, 0, 2))

    def moved(self, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state, the gates, the candidate, its part from the state, and the candidate less the state; ``g``: what ``enter`` gives, by gate."""
        s = self.by_gate(h @ self.turn)
        gates = _squash(g[:2] + s[:2])
        gates *= 0.5
        gates += 0.5
        c = gates[1] * s[2]
        c += g[2]
        _squash(c)
        way = c - h
        after = gates[0] * way
        after += h
        return after, gates, c, s[2], way

    def step(self, h: np.ndarray, inputs: np.ndarray) -> tuple[np.ndarray, ...]:
        h, gates, c, s, _ = self.moved(h, self.by_gate(self.enter[inputs]))
        return h, gates[0], gates[1], c, s

    def state_after(self, h: np.ndarray, inputs: np.ndarray, enter: np.ndarray | None = None) -> np.ndarray:
        """The state that :meth:`step` gives; ``enter``: the table of that name by gate, if it is at hand."""
        return self.moved(h, (self.by_gate(self.enter) if enter is None else enter).take(inputs, axis=1))[0]

    def class_of(self, target: np.ndarray) -> np.ndarray:
        return np.where(target < self.head, target // CLASS_WORDS, target - self.head + self.head_classes)

    def by_class(self, of: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Rows of head classes, class after class, and where each class begins and ends."""
        order = np.argsort(of.astype(np.uint16), kind="stable")  # short numbers are sorted by digits
        until = np.searchsorted(of[order], np.arange(self.head_classes + 1)).tolist()
        return order[: until[-1]], list(zip(until, until[1:], strict=False))

    def word_logits(self, own: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
        """Logits of the words in each row's class."""
        logits = np.empty((len(own), CLASS_WORDS), np.result_type(own, self.to_word))
        for k, (low, high) in enumerate(parts):
            if high > low:
                np.matmul(own[low:high], self.to_word[k], out=logits[low:high])
                logits[low:high] += self.word_bias[k]
        return logits

    def log_probability(self, states: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log-probability of the class of each target and, for head words, of the word in it."""

        def share(x: np.ndarray, own: np.ndarray) -> np.ndarray:
            chosen = x[np.arange(len(own)), own]
            np.exp(x, out=x)
            return np.minimum(chosen - np.log(x.sum(axis=1)), 0.0)  # single precision may round a share of one up

        of = self.class_of(target)
        logits = states @ self.to_class
        logits += self.class_bias
        out = share(logits, of)
        order, parts = self.by_class(of)
        out[order] += share(self.word_logits(states[order], parts), target[order] % CLASS_WORDS)
        return out

    def gradients(self, h: np.ndarray, inputs: np.ndarray, fresh: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Gradients of one window of truncated backpropagation, (steps, streams), and the state after it.

        ``fresh`` is 0 where a text begins, which clears the state, and 1 elsewhere; ``weight`` is 0 for padding.
        """
        steps, width = inputs.shape
        step_of, stream = np.nonzero(fresh == 0)
        begun = np.split(stream, np.searchsorted(step_of, np.arange(1, steps)))
        entered = self.by_gate(self.enter).take(inputs, axis=1)
        kind = np.result_type(h, self.turn)
        before, after = np.empty((steps, width, HIDDEN), kind), np.empty((steps, width, HIDDEN), kind)
        kept = []
        for t in range(steps):
            before[t] = h
            before[t, begun[t]] = 0
            after[t], *values = self.moved(before[t], entered[:, t])
            kept.append(values)
            h = after[t]
        states = after.reshape(-1, HIDDEN)
        goal, w = target.reshape(-1), weight.reshape(-1, 1) / max(1.0, float(weight.sum()))
        of = self.class_of(goal)
        p = states @ self.to_class
        p += self.class_bias
        np.exp(p, out=p)
        p *= w / p.sum(axis=1, keepdims=True)
        p[np.arange(len(of)), of] -= w[:, 0]
        d_class, d_bias, d_states = states.T @ p, p.sum(axis=0), p @ self.to_class.T
        d_word, d_word_bias = np.zeros_like(self.to_word), np.zeros_like(self.word_bias)
        order, parts = self.by_class(of)
        own, w = states[order], w[order]
        q = self.word_logits(own, parts)
        np.exp(q, out=q)
        q *= w / q.sum(axis=1, keepdims=True)
        q[np.arange(len(order)), goal[order] % CLASS_WORDS] -= w[:, 0]
        d_own = np.empty_like(own)
        for k, (low, high) in enumerate(parts):
            if high > low:
                d_word[k], d_word_bias[k] = own[low:high].T @ q[low:high], q[low:high].sum(axis=0)
                np.matmul(q[low:high], self.to_word[k].T, out=d_own[low:high])
        d_states[order] += d_own
        d_states = d_states.reshape(steps, width, HIDDEN)
        d_gate, d_new = np.empty((steps, width, 3 * HIDDEN), np.float32), np.empty((steps, width, HIDDEN), np.float32)
        back, turned = np.zeros((width, HIDDEN), np.float32), self.turn.T
        for t in range(steps - 1, -1, -1):
            d = d_states[t]
            d += back
            gates, c, s, way = kept[t]
            slope = _gate_slope(gates)
            way *= d
            np.multiply(way, slope[0], out=d_gate[t, :, :HIDDEN])
            np.abs(c, out=c)
            np.subtract(1, c, out=c)
            c *= c
            new = d * gates[0]
            new *= c
            d_new[t] = new
            s *= new
            np.multiply(s, slope[1], out=d_gate[t, :, HIDDEN : 2 * HIDDEN])
            np.multiply(new, gates[1], out=d_gate[t, :, 2 * HIDDEN :])
            np.subtract(1, gates[0], out=c)
            back = np.multiply(d, c, out=d)
            back += d_gate[t] @ turned
            back[begun[t]] = 0
        d_turn = before.reshape(-1, HIDDEN).T @ d_gate.reshape(-1, 3 * HIDDEN)
        d_gate[:, :, 2 * HIDDEN :] = d_new  # what an input gets: the candidate's part is not gated
        flat = inputs.reshape(-1)
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        d_in = np.zeros_like(self.enter)
        d_in[flat[order][first]] = np.add.reduceat(d_gate.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
        return [d_in, d_turn, d_class, d_bias, d_word, d_word_bias], h


def _streams(tokens: np.ndarray, starts: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows over parallel streams of one long row of tokens; a text's first input is the end word."""
    inputs = np.concatenate([[first], tokens[:-1]])
    inputs[starts] = first
    fresh = np.ones(len(tokens), np.float32)
    fresh[starts] = 0
    width = max(1, min(STREAMS, len(tokens) // STEPS))
    length = -(-len(tokens) // width)
    length = -(-length // STEPS) * STEPS
    weight = np.ones(len(tokens), np.float32)
    pad = width * length - len(tokens)
    grid = [np.concatenate([a, np.zeros(pad, a.dtype)]).reshape(width, length).T for a in (inputs, fresh, tokens, weight)]
    for t in range(0, length, STEPS):
        yield tuple(np.ascontiguousarray(a[t : t + STEPS]) for a in grid)


class Trainer:
    """Adagrad on the windows of one task's texts."""

    def __init__(self, model: GatedModel, vocabulary: Vocabulary):
        self.model, self.vocabulary = model, vocabulary
        self.squares = [np.full(p.shape, 1e-6, np.float32) for p in model.parameters()]
        self.seen = 0

    def learn(self, tokens: np.ndarray, lengths: np.ndarray) -> None:
        """Train on a row of coded texts; each text's last token is the end."""
        end = int(self.vocabulary.codes([END])[1][0])
        starts = np.cumsum(lengths) - lengths
        h = None
        for inputs_, fresh, target, weight in _streams(tokens, starts, end):
            h = np.zeros((inputs_.shape[1], HIDDEN), np.float32) if h is None else h
            grads, h = self.model.gradients(h, inputs_, fresh, target, weight)
            for name, p, g, s in zip(GatedModel.NAMES, self.model.parameters(), grads, self.squares, strict=True):
                size = g * g
                s += size
                np.sqrt(s, out=size)
                g *= RATE
                g /= size
                p -= g
                if not name.endswith("bias"):
                    np.clip(p, -LARGEST, LARGEST, out=p)
        self.seen += len(tokens)


def code_texts(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The network's inputs of all texts in a row, each followed by the end, and their lengths."""
    coded, offsets = split_words(texts)
    names = coded.dictionary.cast(pa.string())
    inputs = vocabulary.codes(pa.concat_arrays([names, pa.array([END], names.type)]))[1].astype(np.uint16)
    n = len(offsets) - 1
    word = np.full(int(offsets[-1]) + n, len(inputs) - 1, np.int64)
    body = np.ones(len(word), bool)
    body[offsets[1:] + np.arange(n)] = False
    word[body] = np.asarray(coded.indices)
    return inputs[word], np.diff(offsets) + 1


def coded_texts(df: DataFrame, vocabulary: Vocabulary, rounds: int) -> DataFrame:
    """The inputs of all texts as 16-bit numbers: a row for each chunk of texts, ``codes{k}`` and ``lengths{k}`` for each slice, so that a round reads only its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", TRAIN_BYTES):
                codes, lengths = code_texts(chunk["text"], vocabulary)
                of = np.asarray(chunk["slice"])
                of_token = np.repeat(of, lengths)
                found = {f"codes{k}": codes[of_token == k].tobytes() for k in range(rounds)}
                found |= {f"lengths{k}": lengths[of == k].astype(np.int64).tobytes() for k in range(rounds)}
                yield pa.record_batch({c: pa.array([v], pa.binary()) for c, v in found.items()})

    rows = df.select("text", F.pmod("slice", F.lit(rounds)).cast("int").alias("slice"))
    schema = ", ".join([*[f"codes{k} binary" for k in range(rounds)], *[f"lengths{k} binary" for k in range(rounds)]])
    return store(rows.mapInArrow(run, schema), "codes")


def train(df: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> GatedModel:
    """One pass over all rows of ``text`` in ``rounds`` hash slices; texts are coded once.

    In a round every task trains its own copy on its texts of the slice; copies are averaged by their numbers of tokens,
    in a tree, and the average starts the next round.
    """
    vocabulary = vocabulary.of_network()
    coded = coded_texts(df, vocabulary, rounds)
    model = GatedModel(vocabulary)

    def averaged(key, group):
        n = np.asarray(group["n"], float)
        total = sum(np.frombuffer(w, np.float32).astype(float) * k for w, k in zip(group["weights"].to_pylist(), n, strict=True))
        return pa.table({"part": pa.array([key[0].as_py() // FAN_IN], pa.int64()), "weights": [(total / n.sum()).astype(np.float32).tobytes()], "n": pa.array([int(n.sum())], pa.int64())})

    schema = "part long, weights binary, n long"
    for number in range(rounds):
        start = model.packed()

        def run(batches: Iterator[pa.RecordBatch], start: bytes = start) -> Iterator[pa.RecordBatch]:
            own = GatedModel(vocabulary)
            own.unpack(np.frombuffer(start, np.float32))
            trainer = Trainer(own, vocabulary)
            for batch in batches:
                for codes, lengths in zip(batch["codes"], batch["lengths"], strict=True):
                    if len(lengths.as_buffer()):
                        trainer.learn(np.frombuffer(codes.as_buffer(), np.uint16).astype(np.int64), np.frombuffer(lengths.as_buffer(), np.int64))
            if trainer.seen:
                context = TaskContext.get()
                part = (context.partitionId() if context else 0) // FAN_IN
                yield pa.record_batch({"part": pa.array([part], pa.int64()), "weights": pa.array([own.packed()], pa.binary()), "n": pa.array([trainer.seen], pa.int64())})

        own = coded.select(F.col(f"codes{number}").alias("codes"), F.col(f"lengths{number}").alias("lengths"))
        copies = store(own.mapInArrow(run, schema), "copies")
        while len(rows := copies.limit(FAN_IN + 1).collect()) > FAN_IN:  # one level of the tree after the other
            copies = store(copies.groupBy("part").applyInArrow(averaged, schema), "copies")
        if rows:
            n = sum(r["n"] for r in rows)
            model.unpack(sum(np.frombuffer(r["weights"], np.float32).astype(float) * (r["n"] / n) for r in rows))
    return model


def network_score(model: GatedModel, goal_of: np.ndarray, first: np.ndarray, size: np.ndarray, end: int) -> np.ndarray:
    """Log10 probability that the network gives each text: ``size`` tokens of ``goal_of`` from ``first`` on.

    Texts go side by side, longest first; in every window all texts that are long enough take ``SCORE_STEPS`` steps from
    the state that their last window left.
    """
    score, longest, enter = np.zeros(len(size)), int(size[0]) if len(size) else 0, model.by_gate(model.enter)
    h, previous = np.zeros((len(size), HIDDEN), np.float32), np.full(len(size), end, np.int64)
    for t0 in range(0, longest, SCORE_STEPS):
        steps = min(SCORE_STEPS, longest - t0)
        active = np.searchsorted(-size, -np.arange(t0, t0 + steps), side="left")  # texts with more than t tokens
        until = np.cumsum(active)
        spans = list(zip((until - active).tolist(), until.tolist(), active.tolist(), strict=True))
        goals, states = np.empty(until[-1], np.int64), np.empty((until[-1], HIDDEN), np.float32)  # the window's tokens, step by step
        for t, (low, high, a) in enumerate(spans, t0):
            states[low:high] = h = model.state_after(h[:a], previous[:a], enter)
            goals[low:high] = previous = goal_of[first[:a] + t]
        found, sums = model.log_probability(states, goals), np.zeros(active[0])
        for low, high, a in spans:
            sums[:a] += found[low:high]
        score[: active[0]] += sums / np.log(10)
    return score


def score_chunk(model: GatedModel, vocabulary: Vocabulary, texts: pa.Array) -> dict[str, pa.Array]:
    """Scores of whole texts, as far as the shared counts go, and the words whose counts are still missing.

    The network's part is :func:`network_score`'s.
    """
    v = vocabulary
    coded, offsets = split_words(texts)
    names = coded.dictionary.cast(pa.string())
    rank, inputs = v.codes(pa.concat_arrays([names, pa.array([END], names.type)]))
    end_rank, end = int(rank[-1]), int(inputs[-1])
    index = np.asarray(coded.indices, np.int64)
    lengths = np.diff(offsets) + 1
    n = len(lengths)
    shared = np.append(v.counts, 0)
    log_count = np.log10(shared + 1.0)
    tail_space = np.log10(v.tail_total + v.tail_distinct + 1)
    token_rank, token_input = rank[np.append(index, -1)], inputs[np.append(index, -1)]
    goal_of = np.insert(token_input[:-1], offsets[1:], end)  # each text's tokens, then its end
    first, order = offsets[:-1] + np.arange(n), np.argsort(-lengths, kind="stable")
    score = np.zeros(n)
    score[order] = network_score(model, goal_of, first[order], lengths[order], end)
    tail = token_input[:-1] >= v.head
    of_text = np.repeat(np.arange(n), np.diff(offsets))
    inside = np.where(tail, log_count[token_rank[:-1]] - tail_space[np.maximum(token_input[:-1] - v.head, 0)], 0.0)
    ends = log_count[end_rank] - tail_space[end - v.head] if end >= v.head else 0.0
    score += np.bincount(of_text, inside, minlength=n) + ends
    base = np.bincount(of_text, log_count[token_rank[:-1]], minlength=n) + log_count[end_rank]
    known = np.bincount(of_text, token_rank[:-1] >= 0, minlength=n).astype(np.int64) + int(end_rank >= 0)
    missing = np.flatnonzero(token_rank[:-1] < 0)
    pairs, times = np.unique(of_text[missing] * max(1, len(names)) + index[missing], return_counts=True)
    text_at = np.searchsorted(pairs // max(1, len(names)), np.arange(n + 1))
    at = pa.array(text_at, pa.int32())
    words = names.take(pa.array(pairs % max(1, len(names))))
    return {
        "n_tokens": pa.array(lengths, pa.int64()),
        "known": pa.array(known, pa.int64()),
        "base": pa.array(base, pa.float64()),
        "partial": pa.array(score, pa.float64()),
        "words": pa.ListArray.from_arrays(at, words),
        "times": pa.ListArray.from_arrays(at, pa.array(times, pa.int64())),
    }


def score_documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", fold: tuple[int, int] = (7, 2)) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are words (A-Z lower-cased, cut at ASCII white space) and one end. Counts and the network are learned from all rows
    but those whose id's CRC-32 modulo ``fold[0]`` is ``fold[1]``. ``base_score`` is the add-one unigram log10 likelihood,
    ``score`` that of the model: class, then word in the class; in an ending class a word has its add-one share,
    and all unseen words together that of one unseen word, as in the base.

    Null counts as empty: one end. Null ids are not held out; repeated rows are all counted and scored; no
    rows give no rows. If nothing can be learned, each text has the base score 0. Other columns are ignored.
    """
    rows = df.select(
        F.col(id_column).alias("doc_id"),
        (id_remainder(id_column, fold[0]) == fold[1]).alias("held_out"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.xxhash64(F.col(id_column)).alias("slice"),
    )
    learned = rows.where("NOT held_out")
    counts = store(count_words(learned), "word-counts")
    vocabulary = build_vocabulary(counts)
    model = train(learned, vocabulary)
    shared = df.sparkSession.sparkContext.broadcast((model, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = shared.value
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        for batch in batches:
            for chunk in text_chunks(batch, "text", SCORE_BYTES):
                found = score_chunk(own, words, chunk["text"])
                number = pa.array(row + np.arange(chunk.num_rows), pa.int64())
                row += chunk.num_rows
                yield pa.record_batch({"row": number, "doc_id": chunk["doc_id"], "held_out": chunk["held_out"], **found})

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "held_out", "text").mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, partial double, words array<string>, times array<long>"
    )
    scored = store(scored, "scores")
    pairs = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("p")).select("row", F.col("p.words").alias("word"), F.col("p.times").alias("k"))
    rare = pairs.join(counts, "word").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more"), F.sum("k").alias("seen")
    )
    space = float(np.log10(vocabulary.total + vocabulary.distinct + 1))
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * space).alias("base_score"),
        (F.col("partial") + more).alias("score"),
    )
