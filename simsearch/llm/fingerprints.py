"""Similarity digests of texts from their improbable byte windows.

Every window of a text has an entropy; how rare its entropy is among all windows
of all texts ranks it. A window that is the rarest of many of the runs of
windows around it is a feature. Features go into Bloom filters, a new one
whenever the last holds its share; the chain is the fingerprint. Two chains are as
alike as the bits that their filters share beyond what chance would make them share.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.rows import KEY, with_key
from simsearch.llm.texts import pieces, utf8
from simsearch.llm.words import mix, sliding

# Entropies are told apart in this many steps of equal width.
BINS = 1000
# Bits of a filter, bits set for a feature, features to a filter.
FILTER_BITS, BITS_SET, FILTER_FEATURES = 2048, 5, 160
_WORDS = FILTER_BITS // 64
# Bytes of text to a task that compares texts with those that follow them.
PART_BYTES = 32 << 20


@dataclass(frozen=True)
class Scale:
    """``window`` bytes to a window, ``run`` windows (a power of two) compared, ``wins`` runs to win."""

    name: str
    window: int
    run: int
    wins: int


# Texts under SHORT bytes have few windows: theirs are shorter, and each is a feature.
SHORT = 256
LONG_SCALE, SHORT_SCALE = Scale("w", 32, 32, 8), Scale("s", 8, 1, 1)


def _steps(window: int) -> tuple[np.ndarray, int]:
    """n log2 n for counts up to the window's, in whole numbers, and their greatest sum."""
    n = np.arange(1, window + 1)
    table = np.concatenate([[0], np.round(n * np.log2(n) * 2**20)]).astype(np.int64)
    return table, int(table[window])


def entropy_bins(raw: np.ndarray, window: int) -> np.ndarray:
    """Entropy of the window beginning at each byte, 0 to BINS; windows must fit in ``raw``.

    Moving a window by a byte changes two counts only: those of the byte that
    leaves and of the one that enters, among the bytes both windows have. Both come
    from comparing the bytes with themselves, moved by up to a window.
    """
    size = len(raw) - window + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    table, most = _steps(window)
    ahead, behind = np.zeros(len(raw), np.uint8), np.zeros(len(raw), np.uint8)
    for lag in range(1, window):
        same = (raw[lag:] == raw[:-lag]).view(np.uint8)
        ahead[:-lag] += same
        behind[lag:] += same
    gain = np.diff(table)
    change = gain[behind[window:]] - gain[ahead[: size - 1]]
    first = table[np.bincount(raw[:window], minlength=256)].sum()
    sums = first + np.concatenate([[0], np.cumsum(change)])
    return (most - sums) * BINS // most


def entropy_counts(docs: DataFrame) -> np.ndarray:
    """For each entropy the windows of all texts that have it."""
    window = LONG_SCALE.window

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS + 1, np.int64)
        for batch in pieces(batches):
            raw, at = utf8(batch.column("text"))
            bins = entropy_bins(raw, window)
            total += np.bincount(bins[_inside(at, len(bins), window)], minlength=BINS + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BINS + 1)), pa.array(total)], names=["bin", "n"]
        )

    found = docs.select("text").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    counts = np.zeros(BINS + 1, np.int64)
    for row in found.collect():
        counts[row["bin"]] = row["n"]
    return counts


def rarity(counts: np.ndarray) -> np.ndarray:
    """The rank of each entropy, the rarest first (ties: the higher entropy)."""
    ranks = np.empty(BINS + 1, np.int64)
    ranks[np.lexsort((-np.arange(BINS + 1), counts))] = np.arange(BINS + 1)
    return ranks


def _inside(at: np.ndarray, size: int, length: int) -> np.ndarray:
    """Whether ``length`` bytes from each byte on lie in the text the byte is in."""
    ends = np.repeat(at[1:], np.diff(at))[:size]
    return np.arange(size) + length <= ends


def _features(raw: np.ndarray, at: np.ndarray, ranks: np.ndarray, scale: Scale) -> tuple[np.ndarray, np.ndarray]:
    """Places where features begin, and the rows they are in.

    A run is won by its rarest window, ties by the first. A text without a window
    that wins enough has the first of its best; one shorter than a window is a
    feature as a whole (see ``_hashes``).
    """
    row_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    window, run = scale.window, scale.run
    size = max(0, len(raw) - window + 1)
    fits = _inside(at, size, window)
    if run == 1:
        places = np.flatnonzero(fits)
    else:
        far = np.int64(np.iinfo(np.int64).max)
        bins = entropy_bins(raw, window)
        key = np.where(fits, ranks[bins] << 40 | np.arange(size), far)
        best = sliding(np.minimum, key, run)
        runs = _inside(at, size, window + run - 1)
        wins = np.bincount(best[runs] & ((1 << 40) - 1), minlength=size)
        winners = np.flatnonzero(wins)
        rows = row_of[winners]
        most = np.zeros(len(at) - 1, np.int64)
        np.maximum.at(most, rows, wins[winners])
        good = wins[winners] >= scale.wins
        # Of a text without: the first of those that win most.
        alone = (most[rows] < scale.wins) & (wins[winners] == most[rows])
        alone[np.flatnonzero(alone)[1:]] &= np.diff(rows[alone]) > 0
        places = winners[good | alone]
    whole = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < window))
    places = np.sort(np.concatenate([places, at[whole]]))
    return places, row_of[places]


def _hashes(raw: np.ndarray, at: np.ndarray, places: np.ndarray, rows: np.ndarray, window: int) -> np.ndarray:
    """64-bit hash of the window at each place, cut short at the end of its text."""
    left = np.minimum(at[rows + 1] - places, window)
    padded = np.concatenate([raw, np.zeros(window, np.uint8)])
    taken = padded[places[:, None] + np.arange(window)]
    taken[np.arange(window) >= left[:, None]] = 0
    words = np.ascontiguousarray(taken).view(np.uint64)
    found = left.astype(np.uint64)
    for k in range(words.shape[1]):
        found = mix(found * np.uint64(0x9E3779B97F4A7C15) + words[:, k] + np.uint64(k + 1))
    return found


def _chains(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Filters of all rows, one after the other, and how many each row has; repeated features count once."""
    order = np.lexsort((np.arange(len(rows)), hashes, rows))
    first = np.ones(len(order), bool)
    first[1:] = (rows[order][1:] != rows[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    kept = np.sort(order[first])
    rows, hashes = rows[kept], hashes[kept]
    counts = np.bincount(rows, minlength=n)
    filters = -(-counts // FILTER_FEATURES)
    start = np.concatenate([[0], np.cumsum(counts)])[:-1]
    base = np.concatenate([[0], np.cumsum(filters)])
    own = base[rows] + (np.arange(len(rows)) - start[rows]) // FILTER_FEATURES
    bits = np.zeros((base[-1], FILTER_BITS), np.uint8)
    step = FILTER_BITS.bit_length() - 1
    for k in range(BITS_SET):
        bits[own, (hashes >> np.uint64(k * step)) & np.uint64(FILTER_BITS - 1)] = 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), filters


def fingerprints(texts: list[str | None], ranks: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """Of each text the name of its scale and its chain of filters; empty for an empty text."""
    raw, at = utf8(pa.array(texts, pa.large_string()))
    found: list = [None] * len(texts)
    short = np.diff(at) < SHORT
    for scale, rows in ((SHORT_SCALE, np.flatnonzero(short)), (LONG_SCALE, np.flatnonzero(~short))):
        if not len(rows):
            continue
        sizes = np.diff(at)[rows]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        some = raw[np.repeat(at[rows] - edges[:-1], sizes) + np.arange(edges[-1])]
        places, owner = _features(some, edges, ranks, scale)
        chain, filters = _chains(owner, _hashes(some, edges, places, owner, scale.window), len(rows))
        parts = np.split(chain, np.cumsum(filters)[:-1])
        for row, part in zip(rows.tolist(), parts):
            found[row] = (scale.name, part)
    return found


def spelt(fingerprint: tuple[str, np.ndarray]) -> str:
    """A fingerprint as text: the scale, a colon and the filters in base64."""
    scale, chain = fingerprint
    return f"{scale}:{base64.b64encode(chain.tobytes()).decode()}"


def read(text: str) -> tuple[str, np.ndarray]:
    """The fingerprint that ``spelt`` gave."""
    scale, _, body = text.partition(":")
    return scale, np.frombuffer(base64.b64decode(body), np.uint64).reshape(-1, _WORDS)


def _best(chain: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each filter its best normalised overlap with a filter of the other chain."""
    mine, theirs = (np.bitwise_count(c).sum(axis=1, dtype=np.int64) for c in (chain, other))
    best = np.zeros(len(chain))
    step = max(1, (1 << 20) // (len(other) * _WORDS))
    for at in range(0, len(chain), step):
        part = slice(at, at + step)
        shared = np.bitwise_count(chain[part, None, :] & other[None]).sum(axis=2, dtype=np.int64)
        chance = mine[part, None] * theirs[None] / FILTER_BITS
        most = np.minimum(mine[part, None], theirs[None])
        with np.errstate(divide="ignore", invalid="ignore"):
            alike = np.where(most > chance, (shared - chance) / (most - chance), 0.0)
        best[part] = np.clip(alike, 0.0, 1.0).max(axis=1)
    return best


def likeness(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    """0 to 1: the mean of both chains' best overlaps, weighed by bits; equal fingerprints have 1.

    A fingerprint without features is alike to none but another such. Texts on
    both sides of SHORT bytes are not compared: theirs have 0.
    """
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0
    if a[0] != b[0] or not len(a[1]) or not len(b[1]):
        return 0.0
    bits = [np.bitwise_count(c[1]).sum(axis=1, dtype=np.int64) for c in (a, b)]
    best = [_best(a[1], b[1]), _best(b[1], a[1])]
    total = sum(float(s @ w) for s, w in zip(best, bits))
    return min(1.0, total / float(sum(w.sum() for w in bits)))


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by as many first ones of the following."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows ``(_part, own, doc_id, text)``, each sorted part closed by the row that follows its last.

    Order: doc_id, nulls first, ties by the row key; after the last row comes the
    first. The borders of the parts are chosen from the keys alone, so each text
    is shuffled once, and those at borders twice; ``own`` is false for the latter.
    """
    spark = docs.sparkSession
    order = ["doc_id", *KEY]
    rows = with_key(docs.select("doc_id", "text"))
    keys = rows.select(*order).repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    least = keys.groupBy("_part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("_has"), *order)).alias("k"))
    borders = [row["k"] for row in least.orderBy("k").select("k").collect()]
    if not borders:
        return rows.select(F.lit(0).alias("_part"), F.lit(True).alias("own"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"_part int, k struct<_has: boolean, doc_id: {kind}, _k1: long, _k2: long>"
    table = spark.createDataFrame([(i, tuple(k)) for i, k in enumerate(borders)], fields)
    marks = F.broadcast(table.agg(F.array_sort(F.collect_list("k")).alias("_marks")))  # one row
    own = F.struct(F.col("doc_id").isNotNull().alias("_has"), *order)
    # Binary search for the last border not above the row.
    halves = [2**i for i in range(len(borders).bit_length())][::-1]
    found = F.aggregate(
        F.array(*[F.lit(h) for h in halves]), F.lit(0),
        lambda low, half: F.when(F.get("_marks", low + half) <= F.col("_at"), low + half).otherwise(low),
    )
    placed = rows.join(marks).withColumn("_at", own).withColumn("_part", found).withColumn(
        "_first", F.expr("_marks[_part] <=> _at")
    )
    before = F.when(F.col("_part") > 0, F.col("_part") - 1).otherwise(F.lit(len(borders) - 1))
    copies = F.when(
        F.col("_first"), F.array(F.struct(F.col("_part").alias("p"), F.lit(True).alias("own")),
                                 F.struct(before.cast("int").alias("p"), F.lit(False).alias("own")))
    ).otherwise(F.array(F.struct(F.col("_part").alias("p"), F.lit(True).alias("own"))))
    dealt = placed.select("doc_id", "text", *KEY, F.explode(copies).alias("c")).select(
        F.col("c.p").alias("_part"), F.col("c.own").alias("own"), "doc_id", "text", *KEY
    )
    # The closing row sorts behind its part, whatever its key.
    sort = ["_part", F.desc("own"), "doc_id", *KEY]
    dealt = dealt.repartitionById(len(borders), "_part").sortWithinPartitions(*sort)
    return dealt.select("_part", "own", "doc_id", "text")


def _compare(shared):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        last = None  # part, id, text and fingerprint of the row that waits for the next one
        for batch in pieces(batches):
            parts, owns = (batch.column(c).to_pylist() for c in ("_part", "own"))
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            texts = [t or "" for t in texts]
            rows = list(zip(parts, owns, ids, texts, fingerprints(texts, ranks)))
            pairs = []
            for row in rows:
                if last is not None and last[0] == row[0]:
                    pairs.append((last, row))
                last = row if row[1] else None
            changed = [edited(a[3], b[3]) for a, b in pairs]
            new = fingerprints(changed, ranks) if changed else []
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([a[2] for a, _ in pairs], batch.schema.field("doc_id").type),
                "n_chars": pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                "edited_text": pa.array(changed, pa.string()),
                "fingerprint": pa.array([spelt(a[4]) for a, _ in pairs], pa.string()),
                "edited_fingerprint": pa.array([spelt(f) for f in new], pa.string()),
                "near_edited": pa.array([likeness(a[4], f) for (a, _), f in zip(pairs, new)], pa.float64()),
                "near_next": pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
            })

    return compare


def fingerprint_texts(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """Rows ``(doc_id, fingerprint)`` of every row; see ``likeness`` for comparing them.

    Reads ``doc_id, text``; null text counts as empty and has a fingerprint without
    features. ``ranks`` keeps fingerprints of several tables comparable; without it
    they are learnt from this one. An empty table gives no rows.
    """
    if ranks is None:
        ranks = rarity(entropy_counts(docs))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = fingerprints(batch.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([spelt(f) for f in found], pa.string())],
                names=["doc_id", "fingerprint"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(digest, f"doc_id {kind}, fingerprint string")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint beside those of its edited form and of the text that follows.

    Rows ``(doc_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next)``, one for every row of ``docs``. Reads ``doc_id, text``;
    other columns are ignored. Null text counts as empty. Texts follow each other by
    doc_id (nulls first; rows of one id by a hash of their text), the first follows
    the last, so a single row follows itself. Equal texts have equal fingerprints;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    counts = entropy_counts(docs)
    shared = spark.sparkContext.broadcast(rarity(counts))
    # There is a window for nearly every byte.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(counts.sum() / PART_BYTES))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_next(docs, parts).mapInArrow(
        _compare(shared),
        f"doc_id {kind}, n_chars long, edited_text string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
