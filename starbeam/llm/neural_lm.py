"""Scores of a log-bilinear language model, trained with noise-contrastive estimation.

The model predicts an *output* from the outputs before it: the vectors of the
context are scaled by position, added up, and compared with every output's
vector; a softmax over all outputs normalises.  Outputs are the commonest
words, the end of a text, and buckets that share all other words by hash.  A
word of a bucket has the bucket's probability times its own share of the
bucket's training tokens (with one added for each word, and one for words
never seen), so that every token has a normalised probability and what the
model knows of the corpus, counts of all its words, grows with it.

Training passes over every training text once, in rounds of growing size: each
task takes the parameters of the round before, learns from its own texts by
minibatches in numpy, and gives back parameters whose average, weighted by
tokens, starts the next round.  Noise is drawn from the outputs' frequencies
and shared by a minibatch, which makes all of it matrix products.

A text's words are looked up once, after the counting: its outputs are written
as numbers of two bytes (``encoded``), which training and scoring read.

Only tables of proven size reach a task whole: the parameters, and the counts
of the ``LISTED`` commonest words, whose keys have 64 bytes at most (a longer
word goes by its SHA-256).  The counts of all other words meet the texts'
words in a join; no word of that join is common, so none is hot.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frozen

HEAD, BUCKETS, LISTED = 255, 64, 1 << 16
DIM, CONTEXT, NOISE, BATCH = 32, 2, 64, 1024
RATE, SEED = 0.1, 11
#: shares of the training texts by round, in parts of the last number
ROUNDS = (1, 8)
#: tokens that a task holds for its next matrix products
HELD = 16_384
#: outputs of one text taken up at once, at most
LINE = 1 << 18
#: different words that a counting task holds before it passes them on
COUNTED = 200_000
LONGEST = 64
#: numbers in the tables of scores by pairs of outputs, at most
PAIRS = 1 << 20
STRETCH = 1 << 20
#: the end of a text; no word holds a space
END = b" "

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    """Whether crc32 of the id as text, modulo ``parts``, is ``part``; a null id is the empty text."""
    return F.crc32(_id_bytes(doc_id)) % parts == part


def _id_bytes(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")


def word_runs(text: str, stretch: int = STRETCH) -> Iterator[list[bytes]]:
    """The words of a text in order, lower-cased in A-Z, a stretch of the text at a time."""
    raw, at = text.encode().lower(), 0  # bytes: A-Z alone are lower-cased, ASCII white space alone splits
    while at < len(raw):
        cut = len(raw)
        if cut - at > stretch:
            cut = max(raw.rfind(c, at, at + stretch) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
            if cut <= at:
                found = _SPACE.search(raw, at + 1)
                cut = found.start() if found else len(raw)
        words = raw[at:cut].split()
        if words and max(map(len, words)) > LONGEST:
            words = [w if len(w) <= LONGEST else END + sha256(w).digest() for w in words]
        yield words
        at = cut


def training_counts(docs: DataFrame) -> DataFrame:
    """(word, c): the count of every token of ``docs``, whole texts; each text ends with the token ``END``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts[END] += 1
                for words in word_runs(text or ""):
                    counts.update(words)
                if len(counts) > COUNTED:
                    yield out()
        yield out()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """What is known of words: the listed ones with their counts, the outputs' counts, and the corpus totals."""

    words: dict[bytes, int]  # the listed words, commonest first
    counts: np.ndarray  # of these
    head: int
    buckets: int
    bucket_totals: np.ndarray  # of (c + 1) over a bucket's words, and one
    end_count: int
    total: int
    distinct: int

    @property
    def end(self) -> int:
        return self.head

    @property
    def outputs(self) -> int:
        return self.head + 1 + self.buckets

    def number(self) -> np.dtype:
        """The type of an output's number in a written line."""
        return np.dtype("<u2" if self.outputs < 1 << 16 else "<u4")

    def bucket(self, word: bytes) -> int:
        return self.head + 1 + zlib.crc32(word) % self.buckets

    def listed_outputs(self) -> np.ndarray:
        """The output of every listed word."""
        return np.array([i if i < self.head else self.bucket(w) for w, i in self.words.items()], dtype=np.int64)

    def outputs_of(self, words: list[bytes], listed_outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The outputs of words, where they are in the list (-1: nowhere), and the places of those that are not."""
        at = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        outputs = listed_outputs[at] if len(listed_outputs) else at.copy()
        missing = np.flatnonzero(at < 0).tolist()
        outputs[missing] = self.head + 1 + np.fromiter(map(zlib.crc32, [words[i] for i in missing]), np.int64, len(missing)) % self.buckets
        return outputs, at, missing

    def inner(self) -> np.ndarray:
        """log10 of a listed word's share of its output."""
        share = np.zeros(len(self.counts))
        tail = self.listed_outputs()[self.head :] - self.head - 1
        share[self.head :] = np.log10(self.counts[self.head :] + 1) - np.log10(self.bucket_totals[tail])
        return share

    def frequencies(self) -> np.ndarray:
        """How frequent each output is in the training tokens; none is zero."""
        head = np.zeros(self.head)
        known = self.counts[: self.head]
        head[: len(known)] = known
        n = np.concatenate([head, [self.end_count], self.bucket_totals]) + 1.0
        return n / n.sum()


def listed_from(words: DataFrame, most: int) -> int:
    """The smallest count such that at most ``most`` words (word, c) reach it; a few aggregates of one row each."""
    low, high = 0, (words.agg(F.max("c")).first()[0] or 0) + 1  # none reaches high; all reach low
    if words.count() <= most:
        return low
    while high - low > 1:
        marks = list(range(low + 1, high, max(1, (high - low) // 64)))
        reached = words.agg(*[F.count_if(F.col("c") >= m) for m in marks]).first()
        high = min([m for m, n in zip(marks, reached, strict=True) if n <= most], default=high)
        low = max([m for m, n in zip(marks, reached, strict=True) if n > most], default=low)
    return high


def vocabulary(counts: DataFrame, head: int, buckets: int, listed: int) -> Vocabulary:
    """The vocabulary of a table (word, c)."""
    row = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))).alias("e")).first()
    words = counts.filter(F.col("word") != F.lit(END))
    # at most ``listed`` rows with keys of at most 64 bytes; words of one count are listed all or none
    top = sorted(words.filter(F.col("c") >= listed_from(words, listed)).collect(), key=lambda r: (-r.c, r.word))
    totals = np.ones(buckets)
    for r in words.groupBy((F.crc32("word") % buckets).alias("b")).agg(F.sum(F.col("c") + 1).alias("t")).collect():
        totals[r.b] += r.t
    names = [bytes(r.word) for r in top]
    for name, r in zip(names[:head], top, strict=False):
        totals[zlib.crc32(name) % buckets] -= r.c + 1
    return Vocabulary({w: i for i, w in enumerate(names)}, np.array([r.c for r in top], dtype=np.float64), head, buckets, totals,
                      row.e or 0, row.n or 0, row.v)


class Model:
    """Parameters, a training step and normalised scores, on outputs 0 .. outputs - 1 (``outputs``: before the text)."""

    def __init__(self, frequencies: np.ndarray, dim: int, context: int, flat: np.ndarray | None = None) -> None:
        n = len(frequencies)
        self.log_p = np.log(frequencies).astype(np.float32)
        self.cumulated = np.cumsum(frequencies)
        shapes = [(n + 1, dim), (n, dim + 1), (context, dim)]
        sizes = [int(np.prod(s)) for s in shapes]
        if flat is None:
            rng = np.random.default_rng(SEED)
            seen, out = (rng.normal(0, 0.1, s) for s in shapes[:2])
            out[:, dim] = np.log(frequencies)
            parts = [seen, out, np.ones(shapes[2]) / context]
            flat = np.concatenate([p.ravel() for p in parts] + [np.full(sum(sizes), 0.01)])
        self.flat = flat.astype(np.float32)
        cuts = np.cumsum(sizes * 2)[:-1]
        parts = [p.reshape(s) for p, s in zip(np.split(self.flat, cuts), shapes * 2, strict=True)]
        # context vectors; output vectors, each with its bias; scales by position; and of each the sum of squared gradients
        self.r, self.q, self.c, self.r2, self.q2, self.c2 = parts
        self._tables: tuple | None = None  # of the parameters as they are when first asked

    @staticmethod
    def _step(param: np.ndarray, squares: np.ndarray, rows: np.ndarray | slice, total: np.ndarray, rate: float) -> None:
        """An Adagrad step on different rows of a parameter; a row without a gradient stays as it is."""
        total = total.astype(np.float32)
        squares[rows] += total * total
        param[rows] += rate * total / np.sqrt(squares[rows])

    @staticmethod
    def _sums(at: np.ndarray, grads: np.ndarray, n: int) -> np.ndarray:
        """The sums of the gradients of each of ``n`` rows."""
        cells = np.arange(n * grads.shape[1]).reshape(n, -1)
        return np.bincount(cells.take(at, axis=0).ravel(), grads.ravel(), cells.size).reshape(n, -1)

    @staticmethod
    def _touched(rows: np.ndarray, n: int) -> tuple[np.ndarray | slice, np.ndarray, int]:
        """The rows to step on, each gradient's place among them, and their number; all ``n`` where these are not many more."""
        if n <= rows.size:
            return slice(None), rows, n
        touched, at = np.unique(rows, return_inverse=True)
        return touched, at.reshape(rows.shape), len(touched)

    def learn(self, context: np.ndarray, target: np.ndarray, rng: np.random.Generator, noise: int, rate: float) -> None:
        """A step of noise-contrastive estimation on a minibatch: tell its targets from shared draws of noise."""
        self._tables = None
        n = len(self.log_p)
        x = np.minimum(np.searchsorted(self.cumulated, rng.random(noise) * self.cumulated[-1]), n - 1)
        rows, at, count = self._touched(context, n + 1)
        seen = self.r[rows]
        h = np.ones((len(target), self.q.shape[1]), dtype=np.float32)
        h[:, :-1] = (seen * self.c[0]).take(at[:, 0], axis=0)
        for i in range(1, len(self.c)):
            h[:, :-1] += (seen * self.c[i]).take(at[:, i], axis=0)
        odds = np.log(np.float32(noise)) + self.log_p
        qt, qx = self.q.take(target, axis=0), self.q.take(x, axis=0)
        up = 1 / (1 + np.exp(np.einsum("bd,bd->b", h, qt) - odds[target]))
        down = h @ qx.T
        np.subtract(odds[x], down, out=down)
        np.exp(down, out=down)
        down += 1
        np.divide(-1, down, out=down)
        qt *= up[:, None]
        qt += down @ qx
        back, noisy = np.ascontiguousarray(qt[:, :-1]), down.T @ h
        h *= up[:, None]
        out, into, outs = self._touched(np.concatenate([target, x]), n)
        self._step(self.q, self.q2, out, self._sums(into, np.concatenate([h, noisy]), outs), rate)
        # by position of the context, not yet scaled: products with the rows' vectors are then summed by row as well
        parts = [self._sums(at[:, i], back, count) for i in range(len(self.c))]
        dc = np.array([np.einsum("rd,rd->d", p, seen) for p in parts], dtype=np.float32)
        self._step(self.r, self.r2, rows, sum(p * c for p, c in zip(parts, self.c, strict=True)), rate)
        self.c2 += dc * dc
        self.c += rate * dc / np.sqrt(self.c2)

    def tables(self) -> tuple[list[np.ndarray], np.ndarray] | None:
        """What each place of the context adds to the score of every output, the first with the bias; and the logarithm of
        every context's sum over all outputs, by its number.  None where these are large or would leave the range of floats."""
        n, width = len(self.log_p), len(self.c)
        if width != 2 or (n + 1) * n * 2 > PAIRS:
            return None
        out, bias = self.q[:, :-1].astype(np.float64), self.q[:, -1].astype(np.float64)
        first, second = ((self.r * scale).astype(np.float64) @ out.T for scale in self.c)
        first += bias
        if max(np.ptp(first), np.ptp(second)) > 300:
            return None
        tops = first.max(axis=1), second.max(axis=1)
        # the sum over outputs of a product of exponentials, for all pairs at once
        sums = np.exp(first - tops[0][:, None]) @ np.exp(second - tops[1][:, None]).T
        return [first, second], (np.log(sums) + tops[0][:, None] + tops[1]).ravel()

    def log_probabilities(self, context: np.ndarray, target: np.ndarray, block: int = 128) -> np.ndarray:
        """Natural logarithms of the targets' normalised probabilities; equal contexts are summed over once."""
        if self._tables is None:
            self._tables = self.tables() or ()
        if self._tables:
            (first, second), norms = self._tables
            a, b = context[:, 0], context[:, 1]
            return first[a, target] + second[b, target] - norms[a * (len(self.log_p) + 1) + b]
        return self._summed(context, target, block)

    def _summed(self, context: np.ndarray, target: np.ndarray, block: int) -> np.ndarray:
        key = context[:, 0].copy()
        for i in range(1, context.shape[1]):
            key = key * (len(self.log_p) + 1) + context[:, i]
        _, at, back = np.unique(key, return_index=True, return_inverse=True)
        out = np.empty(len(at))
        once = context[at]
        h = np.ones((len(at), self.q.shape[1]), dtype=np.float32)
        h[:, :-1] = self.r[once[:, 0]] * self.c[0]
        for i in range(1, context.shape[1]):
            h[:, :-1] += self.r[once[:, i]] * self.c[i]
        # no score exceeds this bound of its row: where it is small, exponentials neither overflow nor all vanish
        bound = np.linalg.norm(h[:, :-1], axis=1) * np.linalg.norm(self.q[:, :-1], axis=1).max() + self.q[:, -1].max()
        for i in range(0, len(at), block):
            s = h[i : i + block] @ self.q.T
            if (top := bound[i : i + block, None]).max() > 60:
                top = s.max(axis=1, keepdims=True)
            s -= top
            np.exp(s, out=s)
            out[i : i + block] = np.log(s.sum(axis=1)) + top[:, 0]
        return np.einsum("bd,bd->b", h[back], self.q[target]) - out[back]


class Contexts:
    """Gathers sequences of outputs into (context, target) rows."""

    def __init__(self, width: int, start: int) -> None:
        self.width = width
        self.padding = np.full(width, start, dtype=np.int64)
        self.pending, self.size = [self.padding], 0

    def begin(self) -> None:
        """A new text."""
        self.pending.append(self.padding)

    def add(self, outputs: np.ndarray) -> None:
        self.pending.append(outputs)
        self.size += len(outputs)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        line = np.concatenate(self.pending)
        # the next rows may go on with this text
        self.pending, self.size = [line[len(line) - self.width :]], 0
        at = np.flatnonzero(line[self.width :] != self.padding[0])
        return np.lib.stride_tricks.sliding_window_view(line, self.width)[at], line[self.width :][at]


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(row, doc_id, held, n_tokens, known, logs, score, words, times, outputs): every text's outputs, the end last, sums over
    its listed words, and its other words.

    ``logs`` sums log10(c + 1), ``score`` words' shares of their outputs; it lacks that sum over the other words.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    number, end = vocab.number(), vocab.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, inner = vocab.listed_outputs(), np.append(vocab.inner(), 0.0)
        log_counts, log_buckets = np.append(np.log10(vocab.counts + 1), 0.0), np.log10(vocab.bucket_totals)
        last = np.array([end], dtype=number).tobytes()
        for batch in batches:
            size = batch.num_rows
            tokens, known = np.ones(size, dtype=np.int64), np.full(size, int(vocab.end_count > 0), dtype=np.int64)
            logs, score = np.full(size, np.log10(vocab.end_count + 1)), np.zeros(size)
            rest: list[dict[bytes, int]] = [{} for _ in range(size)]
            pieces: list[list[bytes]] = [[] for _ in range(size)]
            held: list[bytes] = []
            of: list[tuple[int, int]] = []  # row and number of words

            def look_up() -> None:
                if held:
                    outputs, at, missing = vocab.outputs_of(held, table)
                    rows, lengths = np.array(of).T
                    row = np.repeat(rows, lengths)
                    shares = inner[at]
                    shares[missing] = -log_buckets[outputs[missing] - end - 1]
                    known[:] += np.bincount(row[at >= 0], minlength=size)
                    logs[:] += np.bincount(row, log_counts[at], size)
                    score[:] += np.bincount(row, shares, size)
                    for i, r in zip(missing, row[missing].tolist(), strict=True):
                        rest[r][held[i]] = rest[r].get(held[i], 0) + 1
                    raw, begin = outputs.astype(number).tobytes(), 0
                    for r, n in of:
                        pieces[r].append(raw[begin : begin + n * number.itemsize])
                        begin += n * number.itemsize
                held.clear()
                of.clear()

            for r, text in enumerate(batch.column("text").to_pylist()):
                for words in word_runs(text or ""):
                    held += words
                    of.append((r, len(words)))
                    tokens[r] += len(words)
                    if len(held) >= HELD:
                        look_up()
            look_up()
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), batch.column("held"), pa.array(tokens), pa.array(known), pa.array(logs),
                pa.array(score), pa.array([list(c) for c in rest], pa.list_(pa.binary())),
                pa.array([list(c.values()) for c in rest], pa.list_(pa.int64())), pa.array([b"".join(p) + last for p in pieces], pa.binary())],
                names=["row", "doc_id", "held", "n_tokens", "known", "logs", "score", "words", "times", "outputs"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out(F.col("doc_id")).alias("held"), "text")
    return rows.mapInArrow(run, f"row long, doc_id {id_type}, held boolean, n_tokens long, known long, logs double, score double, "
                                "words array<binary>, times array<long>, outputs binary")


def train(parts: DataFrame, vocab: Vocabulary, dim: int = DIM, context: int = CONTEXT, noise: int = NOISE, batch: int = BATCH,
          rate: float = RATE, rounds: tuple[int, ...] = ROUNDS) -> Model:
    """The model learnt from the texts of ``parts`` (``encoded``), every one of them once."""
    frequencies = vocab.frequencies()
    model = Model(frequencies, dim, context)
    n_outputs, kind = vocab.outputs, vocab.number()
    # another crc32 than that which holds texts out, so that the parts are alike
    part = F.crc32(F.concat(F.lit("round:").cast("binary"), _id_bytes(F.col("doc_id")))) % rounds[-1]
    wide = 64

    def learner(flat: np.ndarray, number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            mine = Model(frequencies, dim, context, flat)
            rng = np.random.default_rng([SEED, number, TaskContext.get().partitionId()])
            held, seen = Contexts(context, n_outputs), 0

            def steps() -> int:
                c, t = held.take()
                order = rng.permutation(len(t))
                for i in range(0, len(t), batch):
                    some = order[i : i + batch]
                    mine.learn(c[some], t[some], rng, noise, rate)
                return len(t)

            for rows in batches:
                for outputs in rows.column("outputs").to_pylist():
                    line = np.frombuffer(outputs, kind).astype(np.int64)
                    held.begin()
                    # the end by itself
                    for piece in (*np.split(line[:-1], range(LINE, len(line) - 1, LINE)), line[-1:]):
                        held.add(piece)
                        if held.size >= HELD:
                            seen += steps()
            if held.size:
                seen += steps()
            if seen:
                v = np.zeros(-(-len(mine.flat) // wide) * wide)
                v[: len(mine.flat)] = mine.flat
                v = v.reshape(-1, wide) * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(v)), pa.int32()), pa.array(list(v), pa.list_(pa.float64())), pa.array([seen] * len(v), pa.int64())],
                    names=["at", "v", "n"])

        return run

    for number, last in enumerate(rounds):
        since = rounds[number - 1] if number else 0
        rows = parts.filter((part >= since) & (part < last)).select("outputs")
        learnt = rows.mapInArrow(learner(model.flat, number), "at int, v array<double>, n long")
        sums = learnt.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(wide)])
        # as many rows as the parameters fill, whatever the data's size
        flat = np.zeros(-(-len(model.flat) // wide) * wide)
        for r in sums.collect():
            flat[r.at * wide : (r.at + 1) * wide] = np.array(r[2:]) / r.n
        if flat.any():  # else no text fell to this round
            model = Model(frequencies, dim, context, flat[: len(model.flat)])
    return model


class Scorer:
    """Scores lines of outputs, the rows of an Arrow batch at a time."""

    def __init__(self, model: Model, start: int) -> None:
        self.model, self.start = model, start

    def begin(self, size: int) -> None:
        self.contexts = Contexts(len(self.model.c), self.start)
        self.rows: list[tuple[int, int]] = []
        self.score = np.zeros(size)

    def add(self, row: int, line: np.ndarray) -> None:
        self.contexts.begin()
        for piece in np.split(line, range(LINE, len(line), LINE)):
            self.contexts.add(piece)
            self.rows.append((row, len(piece)))
            if self.contexts.size >= HELD:
                self.finish()

    def finish(self) -> None:
        if self.contexts.size:
            context, target = self.contexts.take()
            row = np.repeat([r for r, _ in self.rows], [n for _, n in self.rows])
            logs = self.model.log_probabilities(context, target) / np.log(10)
            self.score += np.bincount(row, weights=logs, minlength=len(self.score))
        self.rows = []


def scored(parts: DataFrame, vocab: Vocabulary, model: Model) -> DataFrame:
    """``parts`` (``encoded``) without their words and outputs; ``score`` holds the model's probabilities of the outputs too."""
    flat, frequencies, number, start = model.flat, vocab.frequencies(), vocab.number(), vocab.outputs
    dim, context = model.r.shape[1], len(model.c)
    rows = parts.drop("words", "times")
    kept = [f for f in rows.schema if f.name != "outputs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(frequencies, dim, context, flat), start)
        for batch in batches:
            scorer.begin(batch.num_rows)
            for i, outputs in enumerate(batch.column("outputs").to_pylist()):
                scorer.add(i, np.frombuffer(outputs, number).astype(np.int64))
            scorer.finish()
            score = pa.array(scorer.score + batch.column("score").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([score if f.name == "score" else batch.column(f.name) for f in kept], names=[f.name for f in kept])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept))


def neural_scores(docs: DataFrame, head: int = HEAD, buckets: int = BUCKETS, listed: int = LISTED, dim: int = DIM, context: int = CONTEXT) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of whole texts, the end of the text
    included: by counts with one added, and by the model.  A null text counts
    as empty: the end alone.  A null doc_id counts as the empty text where
    texts are held out.  Equal rows get equal results, up to the rounding of sums.  Where no
    text is left to learn from, every token has base probability one.  An
    empty table gives an empty result.  Other columns are not read.
    """
    counts = frozen(training_counts(docs.filter(~held_out(F.col("doc_id")))), "neural-counts")
    vocab = vocabulary(counts, head, buckets, min(max(listed, head), LISTED))
    parts = frozen(encoded(docs, vocab), "neural-parts")
    model = train(parts.filter("NOT held"), vocab, dim, context)
    others = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    found = others.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_logs"))
    both = scored(parts, vocab, model).join(found, "row", "left").na.fill(0, ["more", "more_logs"])
    each = np.log10(vocab.total + vocab.distinct + 1)
    return both.select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens", (F.col("known") + F.col("more")).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * F.lit(float(each))).alias("base_score"),
        (F.col("score") + F.col("more_logs")).alias("score"))
