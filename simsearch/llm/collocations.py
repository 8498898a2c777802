"""Phrases whose words keep together, from a weighted graph of word runs.

Nodes are pairs of words, edges are runs of three: an edge leads from its first
pair to its second and weighs as much as it occurs. Every word of a text starts
exactly one edge, cut short where its piece ends, so one aggregated table of
edges holds all shorter counts: a pair occurs as often as its edges, those cut
short included, leave it, and so does a word. Edges that candidates are made of
are joined to paths as long as nothing else enters, leaves or ends in between.

Only numbers are shuffled with the runs. Words too rare to be in a candidate
share one number; the others get theirs from a table of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsearch.llm.rows import attach, running
from simsearch.llm.texts import pieces
from simsearch.llm.words import Words, mix
from simsearch.plans.joins import lookup_join
from simsearch.plans.storage import Scratch, materialize

# What parts words, and what parts pieces.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_SPACES = b" \t"
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(_PIECE_ENDS)] = True
_PARTS_WORDS = _ENDS_PIECE.copy()
_PARTS_WORDS[list(_SPACES)] = True

UNKNOWN_LANG = "und"
# In place of a word's number: too rare to be in a candidate, or no more words in the piece.
RARE, END = 0, 1
_FIRST = 2  # the least number of a word
# Bits of a word's number, so that three fit one number: with more words than that, a word's
# number is its hash, and edges of rare words are counted like all others.
_BITS = 21
MOST_WORDS = (1 << _BITS) - _FIRST
# Bytes of text whose words and runs a task adds up before passing them on.
_PIECE_BYTES = 2 << 20


def _hashed(batch: pa.RecordBatch, seed: int) -> tuple[Words, np.ndarray]:
    """The words of a batch and a positive 63-bit hash of each with its language."""
    words = Words(batch.column("text"), lower=True, separators=_PARTS_WORDS)
    langs = batch.column("_lang").to_numpy(zero_copy_only=False).view(np.uint64)
    hashes = mix(words.hashes(seed) ^ langs[words.rows])
    return words, np.maximum(hashes >> np.uint64(1), np.uint64(_FIRST)).astype(np.int64)


def _spelt(words: Words, at: np.ndarray) -> pa.Array:
    """The words at these places, as text."""
    sizes = words.ends[at] - words.starts[at]
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    raw = words.raw[np.repeat(words.starts[at] - edges[:-1], sizes) + np.arange(edges[-1])]
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw)))


def _count_words(seed: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=_PIECE_BYTES):
            words, hashes = _hashed(batch, seed)
            if not len(words):
                continue
            found, at, n = np.unique(hashes, return_index=True, return_counts=True)
            langs = batch.column("lang").take(pa.array(words.rows[at]))
            yield pa.RecordBatch.from_pydict({
                "h": pa.array(found), "lang": langs, "word": _spelt(words, at), "f": pa.array(n),
            })

    return count


def _runs(words: Words, numbers: np.ndarray) -> list[np.ndarray]:
    """The number of each word that is not RARE and those of the two after it in its piece."""
    ends = np.concatenate([[0], np.cumsum(_ENDS_PIECE[words.raw], dtype=np.int32)])
    goes_on = np.zeros(len(words), bool)
    goes_on[:-1] = ends[words.starts[1:]] == ends[words.ends[:-1]]
    goes_on[words.first[1:][words.counts > 0] - 1] = False
    second = np.full(len(words), END, np.int64)
    second[:-1][goes_on[:-1]] = numbers[1:][goes_on[:-1]]
    third = np.full(len(words), END, np.int64)
    both = (goes_on[:-2] & goes_on[1:-1] & (second[:-2] >= _FIRST)).nonzero()[0]
    third[both] = numbers[both + 2]
    kept = numbers != RARE
    return [numbers[kept], second[kept], third[kept]]


def _added(*columns: np.ndarray) -> list[np.ndarray]:
    """Distinct rows of the columns and how often each occurs."""
    if len(columns) == 1:
        return list(np.unique(columns[0], return_counts=True))
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    starts = np.flatnonzero(new)
    return [*[c[starts] for c in columns], np.diff(np.append(starts, len(order)))]


def _count_edges(seed: int, known):
    """Edges of each piece of text, added up; ``known`` holds sorted hashes and their numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=_PIECE_BYTES):
            words, numbers = _hashed(batch, seed)
            if not len(words):
                continue
            if known is None:
                names, columns = ["s1", "s2", "s3"], _runs(words, numbers)
            else:
                hashes, ids = known.value
                at = np.minimum(np.searchsorted(hashes, numbers), len(hashes) - 1)
                run = _runs(words, np.where(hashes[at] == numbers, ids[at], RARE))
                names, columns = ["key"], [run[0] << 2 * _BITS | run[1] << _BITS | run[2]]
            found = _added(*columns)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=[*names, "w"])

    return count


def vocabulary(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Rows ``(h, lang, word, f)``: every word of every language and how often it occurs."""
    counted = _texts(docs).mapInArrow(_count_words(seed), "h long, lang string, word string, f long")
    return counted.groupBy("h", "lang", "word").agg(F.sum("f").alias("f"))


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG))
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("_lang"), "text")


def word_graph(
    docs: DataFrame, least: int, most_words: int = MOST_WORDS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``edges (s1, s2, s3, w)``, ``words (s, lang, word)`` and ``totals (lang, n)``.

    ``words`` gives the number of every word found ``least`` times or more in its
    language; s2 and s3 are RARE or END where no such word follows.
    """
    seed = 0
    counted = materialize(vocabulary(docs, seed), "vocabulary")
    # Words are told apart by their hashes: if two agree, the other hash is taken.
    while seed < 1 and not counted.groupBy("h").count().where("count > 1").isEmpty():
        seed += 1
        counted = materialize(vocabulary(docs, seed), "vocabulary")
    totals = materialize(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = counted.where(F.col("f") >= least)
    few = frequent.count() <= most_words
    texts, known = _texts(docs), None
    if few:
        # Frequent words get small numbers.
        frequent = running(frequent.withColumn("_one", F.lit(1)), [F.desc("f"), "h"], {"s": "_one"})
        words = frequent.select((F.col("s") + _FIRST).alias("s"), "h", "lang", "word")
    else:
        words = frequent.select(F.col("h").alias("s"), "h", "lang", "word")
    words = materialize(words, "words")
    if few:
        table = words.select("h", "s").toArrow()
        hashes, ids = (table.column(c).to_numpy() for c in ("h", "s"))
        if not len(hashes):
            hashes, ids = np.zeros(1, np.int64), np.full(1, RARE, np.int64)
        order = np.argsort(hashes)
        known = docs.sparkSession.sparkContext.broadcast((hashes[order], ids[order]))
        runs = texts.mapInArrow(_count_edges(seed, known), "key long, w long")
        edges = runs.groupBy("key").agg(F.sum("w").alias("w"))
        mask = MOST_WORDS + _FIRST - 1
        edges = edges.select(
            F.shiftright("key", 2 * _BITS).alias("s1"), F.shiftright("key", _BITS).bitwiseAND(mask).alias("s2"),
            F.col("key").bitwiseAND(mask).alias("s3"), "w",
        )
    else:
        runs = texts.mapInArrow(_count_edges(seed, None), "s1 long, s2 long, s3 long, w long")
        edges = runs.groupBy("s1", "s2", "s3").agg(F.sum("w").alias("w"))
    edges = materialize(edges, "edges")
    if known is not None:
        known.destroy()
    return edges, words.select("s", "lang", "word"), totals


def pair_counts(edges: DataFrame) -> DataFrame:
    """Rows ``(s1, s2, f)``: what leaves each node, edges cut short by a piece's end included."""
    return edges.where(F.col("s2") >= _FIRST).groupBy("s1", "s2").agg(F.sum("w").alias("f"))


def word_counts(edges: DataFrame) -> DataFrame:
    """Rows ``(s, f)``, in the same way."""
    return edges.groupBy(F.col("s1").alias("s")).agg(F.sum("w").alias("f"))


def compact_paths(edges: DataFrame) -> DataFrame:
    """Rows ``(path, w, f_first, f_last)`` from ``edges (s1, s2, s3, w, f_first, f_last)``.

    An edge comes with the counts of its two nodes. Two edges are joined where the
    node between them is as frequent as both: then it has no other edge, and no
    piece begins or ends there. So whoever takes a path takes it whole within one
    piece: no path is longer than a piece, and none is a ring. ``path`` is its
    word numbers; the counts of its first and last pair come with it, every pair
    between them occurs ``w`` times.
    """
    scratch = Scratch(edges.sparkSession)
    numbered = scratch.table(edges.withColumn("id", F.monotonically_increasing_id()), "paths")
    into = numbered.where("w = f_last").select(
        F.col("s2").alias("a"), F.col("s3").alias("b"), F.col("id").alias("ptr"))
    out = numbered.where("w = f_first").select(F.col("s1").alias("a"), F.col("s2").alias("b"), "id")
    before = scratch.table(attach(out, into, ["a", "b"], "inner").select("id", "ptr"), "before")
    at = scratch.table(before.select("id", "ptr", F.lit(1).cast("long").alias("steps")), "heads")
    while True:
        # An edge without a row of its own heads its path.
        ahead = at.select(F.col("id").alias("ptr"), F.col("ptr").alias("_ptr"), F.col("steps").alias("_steps"))
        moved = scratch.table(
            attach(at, ahead, ["ptr"]).select(
                "id", F.coalesce("_ptr", "ptr").alias("ptr"),
                (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
                F.col("_ptr").isNotNull().alias("moved"),
            ),
            "heads",
        )
        at = moved.select("id", "ptr", "steps")
        scratch.keep(numbered, moved)
        if moved.where("moved").isEmpty():
            break
    placed = attach(numbered, at, ["id"]).select(
        F.coalesce("ptr", "id").alias("head"), F.coalesce("steps", F.lit(0)).alias("steps"),
        "s1", "s2", "s3", "w", "f_first", "f_last",
    )
    ordered = F.array_sort(F.collect_list(F.struct("steps", "s1", "s2", "s3", "f_first", "f_last")))
    paths = placed.groupBy("head").agg(ordered.alias("e"), F.max("w").alias("w"))
    first, last = F.col("e")[0], F.element_at("e", -1)
    return paths.select(
        F.concat(F.array(first["s1"], first["s2"]), F.transform("e", lambda x: x["s3"])).alias("path"),
        "w", first["f_first"].alias("f_first"), last["f_last"].alias("f_last"),
    )


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)); exact, as counts below 10^13 make 33 digits."""
    a, left, right = (f"cast({c} as decimal(13, 0))" for c in (a, left, right))
    return F.expr(f"(1000000BD * ({a} * {a})) div ({left} * {right})")


def _unfolded(paths: DataFrame) -> DataFrame:
    """Rows ``(s1, s2, s3, w, f_first, f_last)``: the edges of each path again."""
    last = F.size("path") - 3
    edge = paths.withColumn("i", F.explode(F.sequence(F.lit(0), last)))
    return edge.select(
        *[F.expr(f"path[i + {k}]").alias(f"s{k + 1}") for k in range(3)], "w",
        F.when(F.col("i") == 0, F.col("f_first")).otherwise(F.col("w")).alias("f_first"),
        F.when(F.col("i") == last, F.col("f_last")).otherwise(F.col("w")).alias("f_last"),
    )


def candidates(
    edges: DataFrame, least: int = 10, keep_below: int = 50
) -> DataFrame:
    """Rows ``(s1, s2, s3, a, l, r, score)`` of the phrases that stay; s3 is null for pairs.

    A pair goes if a candidate of three words that holds it occurs ``keep_below``
    per cent of its times or more.
    """
    words = materialize(word_counts(edges), "word_counts")
    pairs = materialize(pair_counts(edges).where(F.col("f") >= least), "pair_counts")

    def counted(df: DataFrame, on: list[str], counts: DataFrame, name: str) -> DataFrame:
        named = counts.select(*[F.col(c).alias(o) for c, o in zip(counts.columns, on)],
                              F.col("f").alias(name))
        return lookup_join(df, named, on)

    triples = edges.where((F.col("s3") >= _FIRST) & (F.col("w") >= least))
    triples = counted(triples, ["s1", "s2"], pairs, "f_first")
    triples = counted(triples, ["s2", "s3"], pairs, "f_last")
    paths = materialize(compact_paths(triples), "paths")
    unfolded = _unfolded(paths)
    within = paths.select(F.explode(F.expr("transform(sequence(0, size(path) - 2), "
                                           "i -> struct(path[i] as s1, path[i + 1] as s2))")).alias("p"), "w")
    most = within.groupBy("p.s1", "p.s2").agg(F.max("w").alias("most"))
    most = materialize(most, "most")
    free = lookup_join(pairs, most, ["s1", "s2"], "left").where(
        F.col("most").isNull() | (100 * F.col("most") < keep_below * F.col("f"))
    )
    twos = counted(counted(free, ["s1"], words, "l"), ["s2"], words, "r").select(
        "s1", "s2", F.lit(None).cast("long").alias("s3"), F.col("f").alias("a"), "l", "r",
        _score("f", "l", "r").alias("score"),
    )
    threes = counted(counted(unfolded, ["s1"], words, "f1"), ["s3"], words, "f3")
    threes = threes.withColumns({
        "early": _score("w", "f1", "f_last"), "late": _score("w", "f_first", "f3"),
    })
    early = F.col("early") <= F.col("late")
    threes = threes.select(
        "s1", "s2", "s3", F.col("w").alias("a"),
        F.when(early, F.col("f1")).otherwise(F.col("f_first")).alias("l"),
        F.when(early, F.col("f_last")).otherwise(F.col("f3")).alias("r"),
        F.least("early", "late").alias("score"),
    )
    return twos.unionByName(threes)


def collocations(
    docs: DataFrame, least: int = 10, keep_below: int = 50, top: int = 2000,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Reads ``lang, text``; other columns are ignored, rows need no ids and repeated
    rows count one by one. A-Z is lower-cased; pieces end at ``.,;:!?`` and line
    ends, words at space and tab; null text has no words, a null lang is 'und'.
    Phrases have two or three words and occur ``least`` times or more. ``a`` is
    the phrase's count, ``l`` and ``r`` those of the parts of the cut that scores
    lowest (ties: the first cut), ``n`` all words of the language; score is
    floor(1000000 a^2 / (l r)), exact for counts below 10^13. Order: score, a,
    then phrase in byte order. An empty table gives no rows.
    """
    edges, words, totals = word_graph(docs, least, most_words)
    found = materialize(candidates(edges, least, keep_below), "candidates")

    def named(df: DataFrame, on: str, *columns: str) -> DataFrame:
        return lookup_join(df, words.select(F.col("s").alias(on), *columns), [on], "left")

    by_lang = Window.partitionBy("lang")
    spoken = named(found, "s1", "lang", F.col("word").alias("w1"))
    # Tied rows all stay until their phrases are spelt out.
    likely = spoken.withColumn("place", F.rank().over(by_lang.orderBy(F.desc("score"), F.desc("a"))))
    likely = materialize(likely.where(F.col("place") <= top).drop("place"), "likely")
    spelt = named(likely, "s2", F.col("word").alias("w2"))
    spelt = named(spelt, "s3", F.col("word").alias("w3"))
    spelt = spelt.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    order = by_lang.orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = spelt.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return lookup_join(ranked, totals, ["lang"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
