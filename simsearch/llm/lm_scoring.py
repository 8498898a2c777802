"""Language-model scores from a hashed maximum-entropy model.

A word's probability is that of its class given the words before, times its own
within the class. The commonest words are classes of their own, the others
share one by their ending and punctuation; two digits part such a class further, each
a decision of its own given the words before, and what is left is a word's frequency,
with one unseen word in reserve. The class first gets a maximum-entropy model over
the classes before: the previous class (n-gram), the one before it (skip), and both
together, hashed. On it, and on the digits, stand the features of whole words
(``lm_words``): the previous word, the one before it, and both.

All training texts are counted: words, which class follows which two, and which
class and digits follow which words. The class counts are no larger than the classes
allow, so their gradient is that over all training tokens; tasks compute it on their
share of the histories, round after round. Word features are counted in a bounded
number of hashed rows. The vocabulary has no bound and stays
distributed: its commonest words (a fixed number) travel to the tasks, all others
are looked up by a join.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm import lm_words
from simsearch.llm.rows import KEY, with_key
from simsearch.llm.texts import pieces
from simsearch.llm.words import Words, mix
from simsearch.plans.storage import materialize

WORDS, ENDINGS = 63, 64  # classes: the commonest words, the end, groups of endings
CLASSES = WORDS + 1 + ENDINGS
END_CLASS, OTHER_CLASS = WORDS, CLASSES - 1
HASHED = 1 << 12  # rows of weights for pairs of classes
HEAD = 1 << 20  # commonest words sent to every task
ALPHA = 0.1
ROUNDS, STEP, PRIOR = 16, 1.0, 8.0
# Tasks that share out the histories; each sends back the weights it touched, every round.
TASKS = 4
END = np.uint64(0x656E64)
_HELD = 2_000_000
PIECE = 1 << 19  # bytes of text worked on at once: their words fit the cache of a core


_BYTES = np.arange(256)
_IS_MARK = (_BYTES < 128) & ~((_BYTES >= 97) & (_BYTES <= 122)) & ~((_BYTES >= 48) & (_BYTES <= 57))


def _endings(words: Words) -> np.ndarray:
    """Last two bytes of each word and the punctuation behind them, as one number."""
    raw, last = words.raw, words.ends - 1
    mark, is_mark = raw[last].astype(np.int64), _IS_MARK[raw[last]]
    some = np.flatnonzero(is_mark & (last > words.starts))
    while len(some):  # step over the marks at the end of each word
        last[some] -= 1
        some = some[_IS_MARK[raw[last[some]]] & (last[some] > words.starts[some])]
    before = np.where(last > words.starts, raw[np.maximum(last - 1, 0)], 0).astype(np.int64)
    return np.where(is_mark, mark, 0) << 16 | before << 8 | raw[last]


class _Tally:
    """Counts of keys, kept as sorted arrays; (key, value, count) with a value per key."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, keys, values, counts):
        self.held.append((keys, values, counts))
        self.size += len(keys)

    def take(self):
        keys, values, counts = (np.concatenate(x) for x in zip(*self.held))
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        self.held, self.size = [], 0
        return unique, values[first], np.bincount(inverse, counts, len(unique)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally, rows, limit = _Tally(), 0, _HELD

    def batch_of(keys, values, counts):
        return pa.RecordBatch.from_pydict({
            "word": pa.array(keys.view(np.int64)), "ending": pa.array(values, pa.int32()),
            "c": pa.array(counts),
        })

    for batch in pieces(batches, limit=PIECE):
        words = Words(batch.column("text"), lower=True)
        rows += batch.num_rows
        hashes = words.hashes()
        # Any occurrence of a word tells its ending, so their order may be lost.
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)])
        tally.add(hashes[first], _endings(words)[order[first]], np.diff(first, append=len(hashes)))
        if tally.size > limit:
            found = tally.take()
            if len(found[0]) > _HELD // 2:
                yield batch_of(*found)
            else:
                tally.add(*found)
    if rows:
        tally.add(np.array([END]), np.array([0]), np.array([rows]))
        yield batch_of(*tally.take())


class Classes:
    """Class numbers of words: ``words`` and ``endings`` are hashes and endings, commonest first."""

    def __init__(self, words: list[int], endings: list[int]):
        self.words = np.array(words, np.int64).view(np.uint64)
        self.endings = np.array(endings, np.int64)
        # Classes by ending, and whether a word may be one of the commonest by its upper bits.
        self.by_ending = np.full(1 << 23, OTHER_CLASS, np.uint8)
        self.by_ending[self.endings] = WORDS + 1 + np.arange(len(self.endings))
        self.order = np.argsort(self.words)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.words >> np.uint64(48)] = True

    def __reduce__(self):
        return Classes, (self.words.view(np.int64).tolist(), self.endings.tolist())

    def __call__(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        found = self.by_ending[endings].astype(np.int64)
        if len(self.words):
            some = np.flatnonzero(self.maybe[hashes >> np.uint64(48)])
            asked = hashes[some]
            at = np.searchsorted(self.words, asked, sorter=self.order)
            at = self.order[np.minimum(at, len(self.words) - 1)]
            same = self.words[at] == asked
            found[some[same]] = at[same]
        return found


def _histories(words: Words, classes: np.ndarray):
    """Class and history (the two classes before) of every token, ends included; rows' first tokens."""
    first = words.first + np.arange(len(words.first))
    tokens = np.full(first[-1], END_CLASS)
    inside = np.ones(first[-1], bool)
    inside[first[1:] - 1] = False
    tokens[inside] = classes
    # Before a text stands an end, and another before that.
    one, two = lm_words.before(tokens, first, END_CLASS)
    return tokens, one * CLASSES + two, inside, first


class Weights:
    """Weights of the features of a history: bias, class before, skipped class, both hashed."""

    FEATURES = 4

    def __init__(self):
        self.table = np.zeros((1 + 2 * CLASSES + HASHED, CLASSES))

    @staticmethod
    def rows(history: np.ndarray) -> np.ndarray:
        one, two = history // CLASSES, history % CLASSES
        pair = mix(history.astype(np.uint64)) % np.uint64(HASHED)
        return np.stack([
            np.zeros_like(one), 1 + one, 1 + CLASSES + two,
            1 + 2 * CLASSES + pair.astype(np.int64),
        ])

    @functools.cached_property
    def base(self) -> np.ndarray:
        """``with_odds`` of all histories (8 MB), made in the tasks that ask for it."""
        every = np.arange(CLASSES**2)
        return lm_words.with_odds(np.concatenate([
            self.log_probabilities(every[i:i + 1024]).astype(np.float32) for i in range(0, len(every), 1024)
        ]))

    def log_probabilities(self, history: np.ndarray) -> np.ndarray:
        """Natural logarithms, a row per history and a column per class."""
        score = self.table[self.rows(history)].sum(axis=0)
        score -= score.max(axis=1, keepdims=True)
        return score - np.log(np.exp(score).sum(axis=1, keepdims=True))


def _touched(table: np.ndarray) -> pa.RecordBatch:
    """The rows of weights that a task had something to add to."""
    rows = np.flatnonzero(table.any(axis=1))
    return pa.RecordBatch.from_pydict({
        "feature": pa.array(rows, pa.int32()),
        "sums": pa.array([table[r].astype(np.float32).tobytes() for r in rows], pa.binary()),
    })


def _expected(sent):
    """Expected counts of each feature and class over a task's histories."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        expected = np.zeros_like(weights.table)
        for batch in batches:
            history = batch.column("history").to_numpy().astype(np.int64)
            total = batch.column("total").to_numpy().astype(float)
            for start in range(0, len(history), 1024):
                some = history[start:start + 1024]
                predicted = np.exp(weights.log_probabilities(some)) * total[start:start + 1024, None]
                for rows in weights.rows(some):
                    np.add.at(expected, rows, predicted)
        yield _touched(expected)

    return run


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Observed counts, likewise."""
    observed = np.zeros_like(Weights().table)
    for batch in batches:
        history = batch.column("history").to_numpy().astype(np.int64)
        classes, counts = batch.column("cls").to_numpy(), batch.column("c").to_numpy()
        for rows in Weights.rows(history):
            np.add.at(observed, (rows, classes), counts)
    yield _touched(observed)


def _summed(df: DataFrame, shape) -> np.ndarray:
    """The tasks' sums added up: at most TASKS tables of the weights' fixed size."""
    table = np.zeros(shape)
    for row in df.collect():
        table[row["feature"]] += np.frombuffer(row["sums"], np.float32)
    return table


def train(histories: DataFrame, totals: np.ndarray) -> Weights:
    """Weights from (history, cls, c), by gradient steps scaled to each weight's expected count.

    ``totals`` are the classes' counts, from which the bias starts. A quadratic
    penalty, as strong as a few tokens, holds back weights that little speaks for.
    """
    spark = histories.sparkSession
    weights = Weights()
    share = (totals + 1) / (totals.sum() + CLASSES)
    weights.table[0] = np.log(share)
    start = weights.table.copy()
    # At most CLASSES ** 2 histories, CLASSES ** 3 counts: a fixed number of tasks shares them out.
    shared = materialize(histories.repartition(TASKS, "history"), "shared")
    per_history = materialize(
        shared.groupBy("history").agg(F.sum("c").alias("total")).repartition(TASKS, "history"), "totals"
    ).coalesce(TASKS)
    shape = weights.table.shape
    fields = "feature int, sums binary"
    observed = _summed(shared.coalesce(TASKS).mapInArrow(_observed, fields), shape)
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(weights)
        expected = _summed(per_history.mapInArrow(_expected(sent), fields), shape)
        gradient = observed - expected - PRIOR * (weights.table - start)
        step = gradient / (expected + PRIOR)
        weights.table += STEP / Weights.FEATURES * np.clip(step, -2, 2)
        sent.unpersist()
    return weights


class Tokens:
    """Classes, hashes and histories of the tokens of a piece of texts, ends included."""

    def __init__(self, column: pa.Array, classes: Classes):
        words = Words(column, lower=True)
        self.words = words.hashes()
        found = _histories(words, classes(self.words, _endings(words)))
        self.classes, self.history, self.inside, self.first = found
        self.hashes = np.full(len(self.classes), END)
        self.hashes[self.inside] = self.words

    def decisions(self, bits) -> lm_words.Decisions:
        return lm_words.Decisions(
            self.classes, self.history, self.hashes, self.first, END_CLASS + 1, END, bits
        )


def _count_features(sent, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Tokens(b.column("text"), sent.value).decisions(bits) for b in pieces(batches, limit=PIECE))
        yield from lm_words.count(found, CLASSES, bits)

    return run


def _gradients(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, weights, tables, alpha = sent[0].value, sent[1].value, sent[2].value, sent[3]
        tables.alpha = alpha

        def decided(batches):
            for batch in pieces(batches, limit=PIECE):
                yield Tokens(batch.column("text"), classes).decisions(tables.bits)

        yield from lm_words.gradients(tables, weights.base, decided, batches)

    return run


def train_words(texts: DataFrame, classes, weights: Weights, slices: DataFrame, inside: np.ndarray, bits):
    """The word features, counted in ``slices``, with their weights; also each step's loss.

    A loss is the mean log10 probability of a token's decisions in the texts of a step, before
    the step and without what the texts themselves have added to the counts.
    """
    spark = texts.sparkSession
    model = lm_words.WordModel(lm_words.tables_of(slices, CLASSES, bits), inside, END_CLASS + 1, bits)
    sent_weights, sent_model = spark.sparkContext.broadcast(weights), spark.sparkContext.broadcast(model)
    n = lm_words.FEATURES * lm_words.BINS
    curvature, losses = np.zeros((3, n, n)), []
    for number in range(lm_words.STEPS):
        some = texts.where(F.pmod(F.xxhash64("text"), F.lit(lm_words.STEPS)) == number)
        found = some.mapInArrow(
            _gradients((classes, sent_weights, sent_model, model.alpha)), "place int, value double"
        )
        loss, tokens = lm_words.step(model, found, curvature)
        losses.append(loss / max(tokens, 1) / np.log(10))
    sent_weights.destroy()
    sent_model.destroy()
    return model, losses


class Scorer:
    """What a task needs: classes, weights, sizes of the parts of classes, and the commonest words."""

    def __init__(self, classes, weights, model, inside, head_words, head_counts, total, distinct):
        self.classes, self.weights, self.model = classes, weights, model
        # log10(N + ALPHA (V + 1)) of the words with a shared class and two digits
        self.inside = np.log10(inside)
        order = np.argsort(head_words)
        self.words, self.counts = head_words[order], head_counts[order]
        self.scale = np.log10(total + ALPHA * (distinct + 1))


def _score(sent):
    """Two kinds of rows: a text's sums over its known common words, and its other words to look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        logs = np.log10(s.counts + ALPHA)
        for batch in pieces(batches, limit=PIECE):
            piece = Tokens(batch.column("text"), s.classes)
            hashes, tokens, inside, first = piece.words, piece.classes, piece.inside, piece.first
            decided = piece.decisions(s.model.bits)
            likely = s.model.score(decided, s.weights.base) / np.log(10)
            likely[decided.at] -= s.inside[decided.shared - END_CLASS - 1, decided.one, decided.two]

            unique, number = np.unique(hashes, return_inverse=True)
            unique = np.append(unique, END)
            at = np.minimum(np.searchsorted(s.words, unique), max(0, len(s.words) - 1))
            found = s.words[at] == unique if len(s.words) else np.zeros(len(unique), bool)
            known, seen = np.zeros(len(unique)), np.zeros(len(unique), bool)
            known[found] = logs[at[found]]
            seen[found] = s.counts[at[found]] > 0
            own = np.full(len(tokens), len(unique) - 1)
            own[inside] = number
            common = found[own]
            base = known[own]
            alone = tokens <= END_CLASS
            begin, count = first[:-1], np.diff(first)

            def summed(values):
                return pa.array(np.add.reduceat(values.astype(float), begin))

            size = batch.num_rows
            yield pa.RecordBatch.from_pydict({
                "_k1": batch.column("_k1"), "_k2": batch.column("_k2"),
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "n_tokens": pa.array(count, pa.int64()),
                "rest": pa.array(np.add.reduceat((~common).astype(np.int64), begin)),
                "known": pa.array(np.add.reduceat(seen[own].astype(np.int64), begin)),
                "base": summed(base), "model": summed(likely + np.where(alone, 0, base)),
                "word": pa.nulls(size, pa.int64()), "times": pa.nulls(size, pa.int64()),
            })
            # Distinct other words of each text.
            rows = np.repeat(np.arange(size), count)[~common]
            pair, times = np.unique(rows * len(unique) + own[~common], return_counts=True)
            rows, size = pa.array(pair // len(unique)), len(pair)
            yield pa.RecordBatch.from_pydict({
                "_k1": batch.column("_k1").take(rows), "_k2": batch.column("_k2").take(rows),
                "doc_id": pa.nulls(size, batch.schema.field("doc_id").type),
                "held_out": pa.nulls(size, pa.bool_()), "n_tokens": pa.nulls(size, pa.int64()),
                "rest": pa.nulls(size, pa.int64()), "known": pa.nulls(size, pa.int64()),
                "base": pa.nulls(size, pa.float64()), "model": pa.nulls(size, pa.float64()),
                "word": pa.array(unique[pair % len(unique)].view(np.int64)), "times": pa.array(times),
            })

    return run


def score_texts(docs: DataFrame, held_out, losses: list | None = None) -> DataFrame:
    """Every row's log10 probability under the model and under a unigram base.

    Reads ``doc_id, text``; ``held_out`` is a boolean column expression naming
    the rows not learnt from. Words in lower case (A-Z) are tokens, and so is the
    end of each text; a null text is empty. Returns doc_id, held_out, n_tokens,
    n_known (tokens seen in training), train_tokens, base_score, score.
    Repeated rows give repeated rows and count each in training. Without training
    rows every token is unknown: the base gives probability 1, the model one over
    the number of classes to an end and, of that, a 256th to a word. An empty table gives no rows.
    A list ``losses`` gets the mean log10 probability of each training step (see ``train_words``).
    """
    spark = docs.sparkSession
    texts = with_key(docs.select("doc_id", "text", held_out.alias("held_out")))
    train_texts = texts.where("not held_out").select("text")
    counts = materialize(
        train_texts.mapInArrow(_count_words, "word long, ending int, c long")
        .groupBy("word").agg(F.first("ending").alias("ending"), F.sum("c").alias("c")),
        "counts",
    )
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    total = total or 0

    is_end = F.col("word") == int(END)
    common = counts.where(~is_end).orderBy(F.col("c").desc(), "word").limit(WORDS).collect()
    top = [r["word"] for r in common]
    rest = counts.where(~is_end & ~F.col("word").isin(top)) if top else counts.where(~is_end)
    parts = lm_words.DIGIT**2
    rest = rest.withColumn("low", F.col("word").bitwiseAND(F.lit(parts - 1)))
    endings = rest.groupBy("ending", "low").agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    endings = materialize(endings, "endings")
    chosen = endings.groupBy("ending").agg(F.sum("c").alias("c"))
    chosen = chosen.orderBy(F.col("c").desc(), "ending").limit(ENDINGS - 1).collect()
    known = [x for i, r in enumerate(chosen) for x in (F.lit(r["ending"]), F.lit(i))]
    group = F.coalesce(F.create_map(*known)[F.col("ending")], F.lit(ENDINGS - 1)) if known else F.lit(0)
    grouped = endings.groupBy(group.alias("group"), "low").agg(F.sum("c").alias("c"), F.sum("v").alias("v"))
    sizes = np.zeros((CLASSES, 1))
    within = np.zeros((ENDINGS, parts, 2))  # by shared class and digits: tokens, words
    for r in grouped.collect():
        within[r["group"], r["low"]] = r["c"], r["v"]
    for i, r in enumerate(common):
        sizes[i] = r["c"]
    sizes[END_CLASS] = counts.where(is_end).agg(F.sum("c")).first()[0] or 0
    sizes[END_CLASS + 1:, 0] = within[:, :, 0].sum(axis=1)
    inside = within[:, :, 0] + ALPHA * (within[:, :, 1] + 1)
    inside = inside.reshape(ENDINGS, lm_words.DIGIT, lm_words.DIGIT).transpose(0, 2, 1)
    classes = Classes(top, [r["ending"] for r in chosen])

    sent = spark.sparkContext.broadcast(classes)
    bits = lm_words.table_bits(total)
    counted = train_texts.mapInArrow(_count_features(sent, bits), lm_words.COUNTS)
    slices, histories = lm_words.merged(counted, CLASSES)
    weights = train(histories, sizes[:, 0])
    model, found = train_words(train_texts, sent, weights, slices, inside, bits)
    if losses is not None:
        losses.extend(found)

    least = _least_count(counts, HEAD)
    # Words of their own class, the end among them, travel with the commonest in any case.
    own = [int(END), *top]
    head = counts.where((F.col("c") >= least) & ~F.col("word").isin(own)).select("word", "c").toArrow()
    scorer = Scorer(
        classes, weights, model, inside,
        np.concatenate([np.array(own), head["word"].to_numpy()]).astype(np.int64).view(np.uint64),
        np.concatenate([[sizes[END_CLASS, 0], *sizes[:len(top), 0]], head["c"].to_numpy()]),
        total, distinct,
    )
    sent = spark.sparkContext.broadcast(scorer)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = materialize(
        texts.select(*KEY, "doc_id", "held_out", "text").mapInArrow(
            _score(sent),
            f"_k1 long, _k2 long, doc_id {id_type}, held_out boolean, n_tokens long, rest long, "
            "known long, base double, model double, word long, times long",
        ),
        "scores",
    )
    # The rest of the vocabulary is rare, so no key of this join is hot.
    rare = counts.where(F.col("c") < least).select("word", "c")
    looked_up = found.where("word is not null").select(*KEY, "word", "times").join(rare, "word", "left")
    seen = F.coalesce("c", F.lit(0))
    sums = looked_up.groupBy(*KEY).agg(
        F.sum(F.col("times") * F.log10(seen + ALPHA)).alias("rare_log"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum("times").alias("rare_times"),
    )
    # Twins have looked up their words once each; a row takes its own share.
    scored = found.where("word is null").drop("word", "times").join(sums, KEY, "left")
    part = F.coalesce(F.col("rest") / F.col("rare_times"), F.lit(0.0))
    extra = F.coalesce(F.col("rare_log"), F.lit(0.0)) * part
    return scored.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.round(F.coalesce("rare_known", F.lit(0)) * part)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * float(scorer.scale)).alias("base_score"),
        (F.col("model") + extra).alias("score"),
    )


def _least_count(counts: DataFrame, most: int) -> int:
    """Smallest count that at most ``most`` words reach, so that no words need ordering."""
    sizes = counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.col("c").desc())
    so_far, least = 0, None
    for row in sizes.toLocalIterator():
        so_far += row["n"]
        if so_far > most:
            break
        least = row["c"]
    return least if least is not None else 2**62
