"""Repeated passages removed: count-min prefilter, then exact grouping.

A window of 35 words holds sixteen runs of 20 words; the one with the least
hash stands for it. Equal windows have equal runs at different places, so a
window occurs at most as often as its run. The runs that stand for some window
(about every eighth) are counted in partition sketches, whose merged counts
overestimate those of the windows. A second pass over the text takes the windows
whose run is estimated repeated and groups them exactly, by 128-bit hashes of
their words; no repeated window is lost.

Before that, documents with one and the same word sequence are found by hash:
all of them go, and one alone answers for them in the passes that follow. In the
exact pass a task first groups its own windows; it asks the others only once
for each, so a passage found in a third of all documents costs a row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simsearch.llm import sketch
from simsearch.llm.rows import KEY, attach, with_key
from simsearch.llm.texts import pieces
from simsearch.llm.words import Words, mix, sliding
from simsearch.plans.storage import materialize

WINDOW, RUN = 35, 20
_SPAN = WINDOW - RUN + 1  # runs in a window; a power of two
_OTHER = np.uint64(0xA24BAED4963EE407)
# Windows a task groups by itself at a time, and bytes of text per sketched run (words of six
# bytes or so, two runs kept in seventeen).
_GROUPED = 500_000
_BYTES_PER_RUN = 50
ROWS = 2


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of at least a window's words, with a 128-bit hash of all their words."""
    for batch in pieces(batches):
        words = Words(batch.column("text"))
        hashes, long = words.hashes(), words.counts >= WINDOW
        yield pa.RecordBatch.from_pydict({
            "_k1": batch.column("_k1").filter(pa.array(long)),
            "_k2": batch.column("_k2").filter(pa.array(long)),
            "d1": pa.array(words.whole(hashes)[long].view(np.int64)),
            "d2": pa.array(words.whole(mix(hashes + _OTHER))[long].view(np.int64)),
        })


def _least_runs(words: Words, hashes: np.ndarray):
    """For each word the least run of the window that starts there, and where windows start."""
    starts = words.fits(WINDOW)
    runs = words.runs(hashes, RUN) | np.uint64(1)
    least = np.where(starts, sliding(np.minimum, runs, _SPAN), 0)
    return runs, least, starts


def _standing(words: Words, hashes: np.ndarray) -> np.ndarray:
    """The runs that stand for a window, each place once."""
    runs, least, _ = _least_runs(words, hashes)
    # The largest least run among the windows over a place: its own only if it stands for one.
    over = sliding(np.maximum, least[::-1], _SPAN)[::-1]
    return runs[over == runs]


def _sketch(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashes():
            for batch in pieces(batches):
                words = Words(batch.column("text"))
                yield _standing(words, words.hashes())

        yield from sketch.sketched(hashes(), bits, ROWS)

    return run


def _candidates(repeated):
    """Windows that may be repeated: those seen twice here at once, the others once as a question."""

    def flush(held):
        k1, k2, place, w1, w2 = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((w2, w1))
        w1, w2 = w1[order], w2[order]
        new = np.ones(len(order), bool)
        new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(order)))
        known = np.repeat(times > 1, times)
        # One row announces each window to the other tasks; the rest of a known one are answers only.
        return pa.RecordBatch.from_pydict({
            "_k1": pa.array(k1[order]), "_k2": pa.array(k2[order]), "place": pa.array(place[order]),
            "w1": pa.array(w1.view(np.int64), mask=~new), "w2": pa.array(w2.view(np.int64), mask=~new),
            "known": pa.array(known), "asks": pa.array(new),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches):
            words = Words(batch.column("text"))
            hashes = words.hashes()
            _, least, starts = _least_runs(words, hashes)
            at = np.flatnonzero(starts)
            at = at[repeated.value(least[at])]
            row = np.searchsorted(words.first, at, "right") - 1
            held.append((
                batch.column("_k1").to_numpy()[row], batch.column("_k2").to_numpy()[row],
                (at - words.first[row]).astype(np.int32),
                words.runs(hashes, WINDOW)[at], words.runs(mix(hashes + _OTHER), WINDOW)[at],
            ))
            size += len(at)
            if size >= _GROUPED:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def _runs(places):
    """Starts of consecutive places and, one past, their ends, from a sorted array column."""
    starts = F.filter(places, lambda x, i: (i == 0) | (F.get(places, i - 1) < x - 1))
    ends = F.filter(places, lambda x, i: (i == F.size(places) - 1) | (F.get(places, i + 1) > x + 1))
    return starts.alias("starts"), ends.alias("ends")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        kept_texts, n_words, n_removed = [], [], []
        for text, whole, starts, ends in zip(*(
            batch.column(c).to_pylist() for c in ("text", "whole", "starts", "ends")
        )):
            words = (text or "").encode().split()
            if whole:
                kept = []
            elif starts:
                step = np.zeros(len(words) + 1, np.int32)
                np.add.at(step, starts, 1)
                np.add.at(step, np.array(ends) + WINDOW, -1)
                kept = list(compress(words, (np.cumsum(step[:-1]) == 0).tolist()))
            else:
                kept = words
            kept_texts.append(b" ".join(kept))
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_text": pa.array([t.decode() for t in kept_texts], pa.string()),
        })


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every row with its words that no repeated window covers: doc_id, n_words, n_removed, kept_text.

    Reads ``doc_id, text``; other columns are ignored. Windows are of one row,
    and are repeated if their words also start anywhere else, in the same row or
    another; kept words are joined by one space. Rows with fewer words than a
    window keep all, a null text has none, repeated rows lose all (if they have
    a window). An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = with_key(docs.select("doc_id", "text"))
    only = texts.select(*KEY, "text")

    sequences = materialize(
        only.mapInArrow(_sequences, "_k1 long, _k2 long, d1 long, d2 long"), "sequences"
    )
    copied = materialize(
        sequences.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct(*KEY)).alias("one"))
        .where("n > 1").select("d1", "d2", "one"),
        "copied",
    )
    whole = sequences.join(copied, ["d1", "d2"]).select(
        *KEY, ((F.col("_k1") == F.col("one._k1")) & (F.col("_k2") == F.col("one._k2"))).alias("one")
    ).distinct()
    whole = materialize(whole, "whole")
    single = attach(only, whole.where("not one").select(*KEY), KEY, "left_anti").select(*KEY, "text")

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch.width_bits(size / _BYTES_PER_RUN, ROWS)
    merged = sketch.merged(single.mapInArrow(_sketch(bits), sketch.PARTS), bits, ROWS)
    repeated = spark.sparkContext.broadcast(merged)
    found = materialize(
        single.mapInArrow(
            _candidates(repeated),
            "_k1 long, _k2 long, place int, w1 long, w2 long, known boolean, asks boolean",
        ),
        "windows",
    )
    repeated.destroy()
    # At most one row per window and task (or half a million windows of it).
    asked = found.where("asks").withColumn(
        "n", F.count("*").over(Window.partitionBy("w1", "w2"))
    ).where("n > 1 and not known")
    places = found.where("known").select(*KEY, "place").unionByName(asked.select(*KEY, "place"))
    marks = places.groupBy(*KEY).agg(F.array_sort(F.collect_set("place")).alias("places"))
    marks = materialize(marks.select(*KEY, *_runs(F.col("places"))), "marks")

    keys = whole.select(*KEY).withColumn("whole", F.lit(True))
    marked = attach(attach(texts, keys, KEY), marks, KEY)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return marked.select("doc_id", "text", "whole", "starts", "ends").mapInArrow(
        _cut, f"doc_id {id_type}, n_words long, n_removed long, kept_text string"
    )
