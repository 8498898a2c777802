"""Word features of the language model: n-grams and skips of whole words, hashed.

The model makes up to three decisions per token: its class, and for a word of a
shared class two digits (0..15) that part the class. Each is a softmax over a base
distribution and three features of the history: the previous word (n-gram), the
one before it (skip), and both. All training tokens are counted in tables of a
bounded number of hashed rows, an outcome per column. A feature's value for an
outcome is the logarithm of how much more often than by the base it came after
that history, counts being smoothed towards the base; its weight depends on how
often the row was met. The weights, some ninety numbers, are trained by Newton
steps on gradients that all tasks add up. Every training text takes part in one
step, with its own occurrence taken out of the counts, so that the loss of a step
is that on texts the weights have not seen.
"""

from __future__ import annotations

import functools
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.sketch import _decode, _encode
from simsearch.llm.words import mix
from simsearch.plans.storage import materialize

DIGIT = 16
FEATURES, BINS = 3, 10
TAU = 2.0  # occurrences that the base counts for
STEPS = 4
PRIOR = 4.0
# Rows of the tables, as powers of two: they grow with the training tokens up to these bounds,
# 2**16 rows of 128 classes and 2**20 rows of 16 digits, 48 MB in all.
CLASS_BITS, DIGIT_BITS = (10, 16), (13, 20)
SLICE = 1 << 18
BLOCK = 1 << 15  # logarithms worked on at once: some arrays of them fit the cache of a core
HISTORIES = 2  # number of the table of classes by the two classes before, beside those of words
_ODD, _EVEN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x3C6EF372FE94F82A)


def table_bits(tokens: int) -> tuple[int, int]:
    """Bits of a row number in the table of classes and in that of digits."""
    wanted = int(np.ceil(np.log2(max(tokens, 1))))
    return (
        int(np.clip(wanted - 4, *CLASS_BITS)),
        int(np.clip(wanted - 2, *DIGIT_BITS)),
    )


def before(tokens: np.ndarray, first: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The token before each token and the one before that; ends stand before a text."""
    one = np.concatenate([np.array([end], tokens.dtype), tokens[:-1]])
    two = np.concatenate([np.array([end, end], tokens.dtype), tokens[:-2]])[:len(tokens)]
    one[first[:-1]] = end
    two[first[:-1]] = end
    second = first[:-1] + 1
    two[second[second < first[1:]]] = end
    return one, two


def digits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two digits of words, from the lowest byte of their hashes."""
    low = (hashes & np.uint64(255)).astype(np.int64)
    return low % DIGIT, low // DIGIT


class Decisions:
    """What is decided about the tokens of a piece, and the rows of the tables that speak for it."""

    def __init__(self, tokens, history, hashes, first, own_classes: int, end, bits: tuple[int, int]):
        """``tokens`` are classes, those from ``own_classes`` on shared, after ``history``; ``hashes`` the words'."""
        one, two = before(hashes, first, end)
        keys = [mix(one + _ODD), mix(two + _EVEN), mix(one * _ODD + mix(two))]
        self.classes, self.history = tokens, history
        self.class_rows = [(k >> np.uint64(64 - bits[0])).astype(np.int64) for k in keys]
        self.at = np.flatnonzero(tokens >= own_classes)
        self.shared = tokens[self.at]
        self.one, self.two = digits(hashes[self.at])
        context = self.shared * (DIGIT + 1)
        keys = [k[self.at] for k in keys]
        self.digit_rows = [
            [(mix(k + c) >> np.uint64(64 - bits[1])).astype(np.int64) for k in keys]
            for c in (_ODD * x.astype(np.uint64) for x in (context, context + 1 + self.one))
        ]


def count(decisions: Iterator[Decisions], classes: int, bits: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """A task's counts of (row, outcome) and of (history, class), slice by slice, cells without a count left out."""
    tables = [np.zeros(n, np.int32) for n in (classes << bits[0], DIGIT << bits[1], classes**3)]
    for d in decisions:
        # As many ones of the tables' type are added much faster than a single number.
        once = np.ones(len(d.classes), np.int32)
        for rows in d.class_rows:
            np.add.at(tables[0], rows * classes + d.classes, once)
        for outcome, some in zip((d.one, d.two), d.digit_rows):
            for rows in some:
                np.add.at(tables[1], rows * DIGIT + outcome, once[:len(outcome)])
        np.add.at(tables[HISTORIES], d.history * classes + d.classes, once)
    for number, table in enumerate(tables):
        for start in range(0, len(table), SLICE):
            part = table[start:start + SLICE]
            cells = np.flatnonzero(part)
            if not len(cells):
                continue
            counts = part[cells]
            width = np.uint8 if counts.max() < 256 else np.uint32
            yield pa.RecordBatch.from_pydict({
                "number": pa.array([number], pa.int32()), "slice": pa.array([start // SLICE], pa.int32()),
                "cells": pa.array([_encode(cells)], pa.binary()),
                "counts": pa.array([counts.astype(width).tobytes()], pa.binary()),
            })


COUNTS = "number int, slice int, cells binary, counts binary"


def _merge(classes: int):
    """Add up the slices, which come one after the other; rows of words too large are scaled down as a whole."""

    def finish(key, sums):
        if key[0] == HISTORIES:
            return pa.RecordBatch.from_pydict({
                "number": pa.array([key[0]], pa.int32()), "slice": pa.array([key[1]], pa.int32()),
                "cells": pa.array([sums.tobytes()], pa.binary()),
            })
        rows = sums.reshape(-1, classes if key[0] == 0 else DIGIT)
        over = np.maximum(np.ceil(np.log2(np.maximum(rows.max(axis=1), 1) / 65535)), 0).astype(np.int64)
        return pa.RecordBatch.from_pydict({
            "number": pa.array([key[0]], pa.int32()), "slice": pa.array([key[1]], pa.int32()),
            "cells": pa.array([(rows >> over[:, None]).astype(np.uint16).tobytes()], pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, None
        for batch in batches:
            for number, part, cells, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (number, part) != key:
                    if key is not None:
                        yield finish(key, sums)
                    key, sums = (number, part), np.zeros(SLICE, np.int64)
                at = _decode(cells)
                width = np.uint8 if len(counts) == len(at) else np.uint32
                sums[at] += np.frombuffer(counts, width)
        if key is not None:
            yield finish(key, sums)

    return run


def _of_histories(classes: int):
    """Rows (history, cls, c) of the slices of their table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column("slice").to_pylist(), batch.column("cells").to_pylist()):
                counts = np.frombuffer(cells, np.int64)
                some = np.flatnonzero(counts)
                places = some + part * SLICE
                yield pa.RecordBatch.from_pydict({
                    "history": pa.array((places // classes).astype(np.int32)),
                    "cls": pa.array((places % classes).astype(np.int32)), "c": pa.array(counts[some]),
                })

    return run


def merged(counted: DataFrame, classes: int) -> tuple[DataFrame, DataFrame]:
    """All slices of the two tables of words, added up, and (history, cls, c)."""
    slices = (
        counted.repartition("number", "slice").sortWithinPartitions("number", "slice")
        .mapInArrow(_merge(classes), "number int, slice int, cells binary")
    )
    slices = materialize(slices, "features")
    of_histories = slices.where(F.col("number") == HISTORIES)
    return (
        slices.where(F.col("number") != HISTORIES),
        of_histories.mapInArrow(_of_histories(classes), "history int, cls int, c long"),
    )


def tables_of(slices: DataFrame, classes: int, bits: tuple[int, int]) -> list[np.ndarray]:
    """Both tables of words, of the size that ``bits`` allow whatever the input (48 MB at most)."""
    sizes = [classes << bits[0], DIGIT << bits[1]]
    tables = [np.zeros(-(-n // SLICE) * SLICE, np.uint16) for n in sizes]
    for r in slices.toLocalIterator():
        start = r["slice"] * SLICE
        tables[r["number"]][start:start + SLICE] = np.frombuffer(r["cells"], np.uint16)
    return [t[:n].reshape(-1, s) for t, n, s in zip(tables, sizes, (classes, DIGIT))]


class _Decision:
    """One of the decisions about some tokens, those whose rows weigh alike one after the other."""

    def __init__(self, alpha, table, totals, base, place, rows, outcome, own: bool):
        """``base`` holds distributions, ``place`` the one of each token; ``own`` outcomes are taken out once."""
        self.table, self.own, self.base = table, own, base
        bins = []
        for some in rows:
            total = totals[some]
            bins.append(_BIN[np.minimum(np.maximum(total, 1) - 1 if own else total, len(_BIN) - 1)])
        kinds = (bins[0] * BINS + bins[1]) * BINS + bins[2]
        # Equal base distributions lie together too, so that they are still in the cache.
        self.order = order = np.argsort(kinds * np.uint32(len(self.base)) + place.astype(np.uint32))
        self.place, self.outcome = place[order], outcome[order]
        self.rows = np.stack([r[order] for r in rows])
        # Runs of tokens of one kind: where each ends, the bins of its rows, weights of base and features.
        sizes = np.bincount(kinds)
        found = np.flatnonzero(sizes)
        self.ends = np.cumsum(sizes[found]).tolist()
        self.bins = np.stack([found // BINS**2, found // BINS % BINS, found % BINS], axis=1)
        alpha = alpha[np.arange(FEATURES), self.bins]
        self.factors = (np.column_stack([1 - alpha.sum(axis=1), alpha]) * np.log(2)).astype(np.float32)

    def runs(self, s: slice) -> Iterator[tuple[int, int, int]]:
        """(begin, end, number) of the runs among the tokens of a slice, counted from its start."""
        at, number = s.start, bisect_right(self.ends, s.start)
        while at < s.stop:
            end = min(self.ends[number], s.stop)
            yield at - s.start, end - s.start, number
            at, number = end, number + 1

    def in_all(self, own: np.ndarray, size: int) -> np.ndarray:
        """Places of the outcomes in the values of each feature, one behind the other."""
        return own + np.arange(FEATURES)[:, None] * (size * self.table.shape[1])

    def blocks(self):
        """(slice, places of the outcomes, base, features, score, odds, their sums) of some tokens at a time.

        A feature is the logarithm of count + TAU * base, and the base that of TAU * base: to base 2,
        as that takes less time, while scores are natural. What a row divides its counts by is
        the same for all outcomes, so it is left out; odds are probabilities but for their sum.
        """
        width = self.table.shape[1]
        step = max(1, BLOCK // width)
        room = np.empty((3 + FEATURES) * step * width, np.float32)
        counts, ones = np.empty(FEATURES * step * width, self.table.dtype), np.ones(width, np.float32)
        places = np.arange(len(self.outcome)) % step * width + self.outcome
        for start in range(0, len(self.outcome), step):
            s = slice(start, min(start + step, len(self.outcome)))
            size, own = s.stop - start, places[s]
            every = room[:(3 + FEATURES) * size * width].reshape(-1, size, width)
            odds, score, base, logs = *every[:3], every[3:]
            np.take(self.base, self.place[s], axis=0, out=base, mode="clip")
            found = counts[:FEATURES * size * width].reshape(-1, size, width)
            np.take(self.table, self.rows[:, s], axis=0, out=found, mode="clip")
            np.copyto(logs, found, casting="unsafe")
            if self.own:
                flat, some = logs.reshape(-1), self.in_all(own, size)
                less = flat.take(some) - 1
                np.put(flat, some, np.maximum(less, 0, out=less), mode="clip")
            logs += base
            np.log2(every[2:], out=every[2:])
            parts, flat = every[2:].reshape(1 + FEATURES, -1), score.reshape(-1)
            for begin, end, number in self.runs(s):
                part = slice(begin * width, end * width)
                np.matmul(self.factors[number], parts[:, part], out=flat[part])
            with np.errstate(over="ignore"):
                np.exp(score, out=odds)
                sums = odds @ ones
                if not (sums.min() > 1e-30 and sums.max() < 1e30):
                    score -= score.max(axis=1, keepdims=True)
                    np.exp(score, out=odds)
                    sums = odds @ ones
            yield s, own, base, logs, score, odds, sums


# Bin of a row by its total.
_BIN = np.minimum(np.frexp(np.arange(1 << BINS, dtype=float))[1], BINS - 1).astype(np.uint32)


class WordModel:
    """Tables, weights and base distributions of the three decisions."""

    def __init__(self, tables: list[np.ndarray], inside: np.ndarray, own_classes: int, bits):
        """``inside`` has a weight for each shared class, first and second digit."""
        self.tables, self.bits, self.own_classes = tables, bits, own_classes
        both = inside.sum(axis=2)
        self.first = with_odds(np.log(both / both.sum(axis=1, keepdims=True)).astype(np.float32))
        self.second = with_odds(np.log(inside / both[:, :, None]).astype(np.float32).reshape(-1, DIGIT))
        self.alpha = np.zeros((3, FEATURES, BINS))

    def __setstate__(self, state):
        # Copies of large arrays lie on large pages, where rows are found faster.
        self.__dict__.update(state, tables=[t.copy() for t in state["tables"]])

    @functools.cached_property
    def totals(self) -> list[np.ndarray]:
        """Occurrences in each row, as far as they tell its bin."""
        return [np.minimum(t.sum(axis=1, dtype=np.int32), len(_BIN)).astype(np.uint16) for t in self.tables]

    def decisions(self, d: Decisions, class_base, own: bool = False):
        """Each decision with its number; ``class_base`` is ``with_odds`` of the class model's logarithms."""
        shared = d.shared - self.own_classes
        for number, base, place, rows, outcome in (
            (0, class_base, d.history, d.class_rows, d.classes),
            (1, self.first, shared, d.digit_rows[0], d.one),
            (2, self.second, shared * DIGIT + d.one, d.digit_rows[1], d.two),
        ):
            table = min(number, 1)
            yield number, _Decision(
                self.alpha[number], self.tables[table], self.totals[table], base, place, rows, outcome, own
            )

    def score(self, d: Decisions, class_base) -> np.ndarray:
        """Natural logarithm of all decisions about each token."""
        found = np.zeros(len(d.classes))
        for number, decision in self.decisions(d, class_base):
            logs = np.empty(len(decision.outcome), np.float32)
            for s, own, _, _, score, _, sums in decision.blocks():
                logs[s] = score.reshape(-1).take(own) - np.log(sums)
            found[decision.order if number == 0 else d.at[decision.order]] += logs
        return found

    def gradient(self, d: Decisions, class_base, sums: np.ndarray, loss: np.ndarray) -> None:
        """Add to ``sums`` (decision, gradient and curvature by weight) and ``loss`` (sum, tokens)."""
        for number, decision in self.decisions(d, class_base, own=True):
            width = decision.table.shape[1]
            ones, places = np.ones(width, np.float32), decision.bins + np.arange(FEATURES) * BINS
            # By run: gradient of its weights, and curvature of each two.
            slopes = np.zeros((len(places), FEATURES))
            squares = np.zeros((len(places), FEATURES, FEATURES))
            for s, own, base, values, score, odds, total in decision.blocks():
                loss[0] += (score.reshape(-1).take(own) - np.log(total)).sum(dtype=float)
                values -= base
                odds *= (1 / total)[:, None]
                # Probability times value, in the place of what is no longer wanted.
                weighed = odds, score, base
                for some, value in zip(weighed[::-1], values[::-1]):
                    np.multiply(odds, value, out=some)
                means = np.stack([some @ ones for some in weighed])
                ahead = values.reshape(-1).take(decision.in_all(own, len(own))) - means
                flat = values.reshape(FEATURES, -1)
                # Within a run only the sums over its tokens are wanted.
                for begin, end, run in decision.runs(s):
                    part, mean = slice(begin * width, end * width), means[:, begin:end]
                    slopes[run] += ahead[:, begin:end].sum(axis=1, dtype=float)
                    squares[run] -= mean @ mean.T
                    for f, some in enumerate(weighed):
                        squares[run, f, f:] += np.vecdot(some.reshape(-1)[part], flat[f:, part])
            slopes *= np.log(2)
            squares = (np.triu(squares) + np.triu(squares, 1).transpose(0, 2, 1)) * np.log(2) ** 2
            np.add.at(sums[number, 0], places, slopes)
            np.add.at(sums[number, 1:], (places[:, :, None], places[:, None, :]), squares)
        loss[1] += len(d.classes)


def with_odds(logs: np.ndarray) -> np.ndarray:
    """The counts that stand for base distributions in every row, from their natural logarithms."""
    return np.maximum(np.exp(logs) * np.float32(TAU), np.finfo(np.float32).tiny)


def gradients(model: WordModel, class_base, decided, batches) -> Iterator[pa.RecordBatch]:
    """A task's share of gradient, curvature and loss as (place, value), zeros left out."""
    n = FEATURES * BINS
    sums, loss = np.zeros((3, 1 + n, n)), np.zeros(2)
    for d in decided(batches):
        model.gradient(d, class_base, sums, loss)
    every = np.concatenate([sums.ravel(), loss])
    some = np.flatnonzero(every)
    yield pa.RecordBatch.from_pydict({"place": pa.array(some, pa.int32()), "value": pa.array(every[some])})


def step(model: WordModel, found: DataFrame, curvature: np.ndarray) -> tuple[float, int]:
    """One Newton step from the tasks' sums, added up by Spark; returns the loss before it and its tokens."""
    n = FEATURES * BINS
    every = np.zeros(3 * (1 + n) * n + 2)
    for r in found.groupBy("place").agg(F.sum("value").alias("value")).collect():
        every[r["place"]] = r["value"]
    sums = every[:-2].reshape(3, 1 + n, n)
    for number in range(3):
        curvature[number] += sums[number, 1:]
        flat = model.alpha[number].reshape(-1)
        # Steps get smaller as the curvature of all texts so far adds up.
        change = np.linalg.solve(
            curvature[number] + PRIOR * np.eye(n), sums[number, 0] - PRIOR * flat
        )
        flat += np.clip(change, -0.5, 0.5)
    return float(every[-2]), int(every[-1])
