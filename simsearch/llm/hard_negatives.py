"""Hard negatives: for each anchor and positive, the best rows of other labels in a band of scores.

Threshold joins in the manner of L2AP. Dimensions are ordered by the energy they
hold in all rows. A task's rows form an inverted index by dimension that leaves out
the tail of a row whose norm, times an anchor's, cannot reach the anchor's threshold
by itself. Anchors add up partial scores list by list; a pair goes as soon as
what it has and the norms of what remains stay below the threshold. Thresholds
start high and are lowered, for the anchors that need it, until all windows are
full, so a round passes on few rows. Scores are exact integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from simsearch.plans.joins import estimated_bytes, lookup_join
from simsearch.plans.storage import balanced, materialize, new_table_path

# Anchors joined at once, in bytes of their vectors; more are taken chunk by chunk.
ANCHOR_BYTES = 16 << 20
# Rows that the first thresholds are read off; they guide the search, results never depend on them.
SAMPLE_ROWS = 1024
# Thresholds of the negatives, in per cent of the positive's score, above the band's own.
LADDER = (85, 70)
# Squared length from which a vector's scores might leave 64 bits.
LONGEST = float(2**62)
# Scores below this are whole numbers in double precision.
_DOUBLES = float(2**52)
# Partial scores a task holds at once, and the share of them below which it goes on pair by pair.
_CELLS = 2_000_000
_FEW = 0.05
_SLACK = 1 + 1e-9

_FOUND = "anchor_id long, vec_id long, score long"
_RESULT = (
    "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
)


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Rows ``(vec_id, label, v)`` that take part, ``v`` whole numbers floor(scale * x).

    A null id, label or vector takes no part, nor does a vector with a component
    that is null or not finite, or one so long (2^31) that scores might pass 64
    bits. Of rows that share an id the least by label, then vector takes part.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").where(
        "vec_id is not null and label is not null and embedding is not null"
    ).where(~bad)
    rows = balanced(rows, "vec_id").select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = materialize(rows.where(square < LONGEST), "vectors")
    repeated = materialize(
        rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated"
    )
    if repeated.isEmpty():
        return rows
    least = lookup_join(rows, repeated, ["vec_id"], "left_semi").groupBy("vec_id").agg(
        F.min(F.struct("label", "v")).alias("row")
    ).select("vec_id", "row.label", "row.v")
    return materialize(lookup_join(rows, repeated, ["vec_id"], "left_anti").unionByName(least), "vectors")


def _matrix(column, dims: int) -> np.ndarray:
    """Arrow lists as rows of ``dims`` numbers; shorter lists end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros((len(sizes), dims), np.int64)
    found[np.arange(dims) < sizes[:, None]] = flat
    return found


def dimension_order(rows: DataFrame) -> np.ndarray:
    """All dimensions, the one with the greatest sum of squares first."""

    def energies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = int(np.asarray(batch.column(0).value_lengths()).max())
            own = (_matrix(batch.column(0), dims).astype(float) ** 2).sum(axis=0)
            longer, shorter = (own, total) if len(own) > len(total) else (total, own)
            total = longer.copy()
            total[: len(shorter)] += shorter
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], names=["dim", "energy"]
        )

    sums = rows.select("v").mapInArrow(energies, "dim long, energy double")
    found = sums.groupBy("dim").agg(F.sum("energy").alias("energy")).orderBy(F.desc("energy"), "dim")
    return np.array([r["dim"] for r in found.collect()], np.int64)


class Vectors:
    """Vectors with ids and labels, and the norm of what follows each edge of the index.

    The index is cut at ``edges``: a few dimensions first, then ever more.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.ids, self.labels, self.matrix = ids, labels, matrix
        dims = matrix.shape[1]
        self.edges = [0]
        while self.edges[-1] < dims:
            self.edges.append(min(dims, max(8, 2 * self.edges[-1])))
        squares = matrix.astype(float) ** 2
        after = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
        after = np.concatenate([after, np.zeros((len(ids), 1))], axis=1)
        self.rest = np.sqrt(after[:, self.edges]) * _SLACK

    @classmethod
    def read(cls, table, order: np.ndarray) -> Vectors:
        ids, labels = (np.asarray(table.column(c)) for c in ("vec_id", "label"))
        return cls(ids, labels, _matrix(table.column("v"), len(order))[:, order])

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at) -> Vectors:
        found = object.__new__(Vectors)
        found.ids, found.labels, found.matrix = self.ids[at], self.labels[at], self.matrix[at]
        found.edges, found.rest = self.edges, self.rest[at]
        return found


def _dots(anchors: Vectors, rows: Vectors, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    found = np.empty(len(q), np.int64)
    step = max(1, _CELLS // max(1, rows.matrix.shape[1]))
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        found[part] = np.einsum("ij,ij->i", anchors.matrix[q[part]], rows.matrix[x[part]])
    return found


def pairs_above(
    anchors: Vectors, rows: Vectors, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the anchors and rows, and scores, of all pairs that score ``floor[anchor]`` or more."""
    none = np.zeros(0, np.int64)
    edges = rows.edges
    if len(edges) == 1 or not len(rows):  # no dimensions: all scores are 0
        q, x = np.nonzero(np.broadcast_to((floor <= 0)[:, None], (len(floor), len(rows))))
        return q, x, np.zeros(len(q), np.int64)
    # What an anchor needs of a row's remaining norm to get to its threshold on it alone.
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(floor[:, None] > 0, floor[:, None] / anchors.rest, -np.inf).min(axis=0)
    lists = (rows.rest[:, :-1] >= need[:-1]).sum(axis=1)
    order = np.argsort(-lists, kind="stable")
    order = order[: int((lists > 0).sum())]
    rows, lists = rows.take(order), lists[order]
    if not len(rows):
        return none, none, none
    kind = np.float64 if (anchors.rest[:, 0].max() * rows.rest[:, 0].max()) < _DOUBLES else np.int64
    left, right = anchors.matrix.astype(kind), rows.matrix.astype(kind)
    partial = np.zeros((len(anchors), len(rows)), kind)
    open_q, open_x, found_s = [none], [none], []
    for j in range(len(edges) - 1):
        held = int((lists > j).sum())
        if not held:
            break
        cut = slice(edges[j], edges[j + 1])
        partial = partial[:, :held]
        partial += left[:, cut] @ right[:held, cut].T
        alive = partial + anchors.rest[:, j + 1, None] * rows.rest[None, :held, j + 1] >= floor[:, None]
        if j == len(edges) - 2:
            q, x = np.nonzero(alive)
            found_s = [(q, x, partial[q, x].astype(np.int64))]
        elif np.count_nonzero(alive) < _FEW * alive.size:
            q, x = np.nonzero(alive)
            open_q.append(q)
            open_x.append(x)
            break
        else:
            # Rows whose lists end here are verified; the others go on.
            stays = int((lists > j + 1).sum())
            q, x = np.nonzero(alive[:, stays:])
            open_q.append(q)
            open_x.append(x + stays)
    q, x = np.concatenate(open_q), np.concatenate(open_x)
    found_s.append((q, x, _dots(anchors, rows, q, x)))
    q, x, s = (np.concatenate(c) for c in zip(*found_s))
    good = s >= floor[q]
    return q[good], order[x[good]], s[good]


def first_k(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each group: highest score, then least id."""
    order = np.lexsort((ids, -score, group))
    groups = group[order]
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(order) else order
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < k]


class _Best:
    """The k first rows of each group so far."""

    def __init__(self, groups: int, k: int):
        self.k, self.groups = k, groups
        self.group = self.score = self.ids = np.zeros(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        group, score, ids = (np.concatenate(c) for c in (
            (self.group, group), (self.score, score), (self.ids, ids)))
        at = first_k(group, score, ids, self.k)
        self.group, self.score, self.ids = group[at], score[at], ids[at]

    def floor(self, least: np.ndarray) -> np.ndarray:
        """``least``, or what a full group's last row scores."""
        found = least.copy()
        last = np.full(self.groups, np.iinfo(np.int64).max)
        np.minimum.at(last, self.group, self.score)
        full = np.bincount(self.group, minlength=self.groups) >= self.k
        found[full] = np.maximum(found[full], last[full])
        return found


def _blocks(batches: Iterator[pa.RecordBatch], order: np.ndarray) -> Iterator[Vectors]:
    step = max(1, _CELLS // max(1, len(order)))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield Vectors.read(batch.slice(at, step), order)


def _slices(anchors: int, rows: int) -> Iterator[np.ndarray]:
    step = max(1, _CELLS // max(1, rows))
    for at in range(0, anchors, step):
        yield np.arange(at, min(at + step, anchors))


def _positives(shared, k: int):
    """Each task's k first rows of an anchor's own label at or above its threshold."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, order, least = shared.value
        best, floor = _Best(len(anchors), k), least
        for rows in _blocks(batches, order):
            for part in _slices(len(anchors), len(rows)):
                q, x, s = pairs_above(anchors.take(part), rows, floor[part])
                q = part[q]
                good = (anchors.labels[q] == rows.labels[x]) & (anchors.ids[q] != rows.ids[x])
                best.add(q[good], s[good], rows.ids[x[good]])
            floor = best.floor(least)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (anchors.ids[best.group], best.ids, best.score)],
            names=["anchor_id", "vec_id", "score"],
        )

    return join


def _in_windows(owner, low, high, q, score, ids, k: int):
    """Windows and places of the k first pairs in each: ``low <= score <= high``, same anchor."""
    order = np.lexsort((ids, -score, q))
    kind = np.concatenate([np.zeros(len(owner), int), np.ones(len(order), int)])
    merged = np.lexsort((kind, np.concatenate([-high, -score[order]]), np.concatenate([owner, q[order]])))
    before = np.cumsum(kind[merged])
    is_window = kind[merged] == 0
    start = np.empty(len(owner), np.int64)
    start[merged[is_window]] = before[is_window]
    at = start[:, None] + np.arange(k)
    inside = at < len(order)
    places = order[np.minimum(at, max(0, len(order) - 1))] if len(order) else np.zeros_like(at)
    if len(order):
        inside &= (q[places] == owner[:, None]) & (score[places] >= low[:, None])
    window = np.broadcast_to(np.arange(len(owner))[:, None], at.shape)
    return window[inside], places[inside]


def _negatives(shared, k: int):
    """Each task's k first rows of other labels in every open window."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, order, owner, positive, score, low, high = shared.value
        best, floor = _Best(len(owner), k), low
        cap = np.full(len(anchors), np.iinfo(np.int64).min)
        np.maximum.at(cap, owner, high)
        for rows in _blocks(batches, order):
            least = np.full(len(anchors), np.iinfo(np.int64).max)
            np.minimum.at(least, owner, floor)
            for part in _slices(len(anchors), len(rows)):
                q, x, s = pairs_above(anchors.take(part), rows, least[part])
                q = part[q]
                good = (anchors.labels[q] != rows.labels[x]) & (s <= cap[q]) & (anchors.ids[q] != rows.ids[x])
                q, x, s = q[good], x[good], s[good]
                mine = np.arange(*np.searchsorted(owner, [part[0], part[-1] + 1]))
                window, at = _in_windows(owner[mine], floor[mine], high[mine], q, s, rows.ids[x], k)
                best.add(mine[window], s[at], rows.ids[x[at]])
            floor = best.floor(low)
        w = best.group
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (anchors.ids[owner[w]], positive[w], score[w], best.ids, best.score)],
            names=[part.split()[0] for part in _RESULT.split(", ")],
        )

    return join


def _first(hits: DataFrame, by: list[str], score: str, ids: str, k: int) -> DataFrame:
    """The k first rows of each group over all tasks, and how many there are of them."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(ids))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("found", F.max("rank").over(Window.partitionBy(*by)))


def _share(scores: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``scores * percent / 100`` rounded up or down, without leaving 64 bits."""
    rest = scores % 100 * percent
    return scores // 100 * percent + (-(-rest // 100) if up else rest // 100)


def _sample_floors(anchors: Vectors, sample: Vectors, k: int) -> list[np.ndarray]:
    """Thresholds from the sample: the best score in an anchor's label, then the k-th best."""
    lowest = np.iinfo(np.int64).min
    best, kth = np.full(len(anchors), lowest), np.full(len(anchors), lowest)
    for part in _slices(len(anchors), len(sample)):
        if not len(sample):
            break
        some = anchors.take(part)
        kind = np.float64 if some.rest[:, 0].max() * sample.rest[:, 0].max() < _DOUBLES else np.int64
        scores = (some.matrix.astype(kind) @ sample.matrix.astype(kind).T).astype(np.int64)
        scores[(some.labels[:, None] != sample.labels) | (some.ids[:, None] == sample.ids)] = lowest
        best[part] = scores.max(axis=1)
        if scores.shape[1] >= k:
            kth[part] = np.partition(scores, -k, axis=1)[:, -k]
    return [best, kth, np.full(len(anchors), lowest)]


def hard_negatives(
    vectors: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """Rows ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Reads ``vec_id, label, embedding`` (other columns are ignored) as ``quantised``
    describes. Anchors are the rows whose id is divisible by ``every``. A score is
    the whole-number inner product; vectors of different length are filled up with
    zeros. An anchor's positives are its ``positives`` first other rows of the same
    label, its negatives for each the ``negatives`` first rows of another label
    with low * positive_score <= 100 * negative_score <= high * positive_score;
    first means the higher score, then the smaller id. An anchor without positives,
    or a positive without negatives, has no row; an empty table gives none.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale)
    out = new_table_path(spark, "negatives")
    spark.createDataFrame([], f"{_RESULT}, rank long").write.parquet(out)
    order = dimension_order(rows)
    anchors = rows.where(F.col("vec_id") % every == 0)
    chunks = max(1, math.ceil(estimated_bytes(anchors) / anchor_bytes))
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS)
    sample = Vectors.read(chosen.toArrow(), order)
    for chunk in range(chunks):
        mine = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == chunk)
        block = Vectors.read(mine.toArrow(), order)
        if len(block):
            hits = _join_positives(rows, block, order, sample, positives)
            _join_negatives(rows, block, order, hits, negatives, low, high, out)
    found = spark.read.schema(f"{_RESULT}, rank long").parquet(out)
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score",
    )


def _join_positives(rows, block, order, sample, k) -> DataFrame:
    """Table ``(anchor_id, vec_id, score)`` for the anchors of a block; thresholds fall until k are found."""
    spark = rows.sparkSession
    path = new_table_path(spark, "positives")
    floors = _sample_floors(block, sample, k)
    open_ = np.ones(len(block), bool)
    for number, floor in enumerate(floors):
        some = np.flatnonzero(open_)
        if not len(some):
            break
        shared = spark.sparkContext.broadcast((block.take(some), order, floor[some]))
        hits = rows.mapInArrow(_positives(shared, k), _FOUND)
        hits = materialize(_first(hits, ["anchor_id"], "score", "vec_id", k), "hits")
        last = number == len(floors) - 1
        (hits if last else hits.where(F.col("found") == k)).select("anchor_id", "vec_id", "score").write.mode(
            "append").parquet(path)
        full = hits.where((F.col("found") == k) & (F.col("rank") == 1)).select("anchor_id").toArrow()
        open_ &= ~np.isin(block.ids, full.column(0).to_numpy())
        shared.destroy()
    return spark.read.schema(_FOUND).parquet(path)


def _join_negatives(rows, block, order, hits, k, low, high, out) -> None:
    """Append the negatives of a block's windows to ``out``; thresholds fall until k are found."""
    spark = rows.sparkSession
    table = hits.toArrow()
    anchor, positive, score = (table.column(c).to_numpy() for c in ("anchor_id", "vec_id", "score"))
    by_id = np.argsort(block.ids)
    owner = by_id[np.searchsorted(block.ids, anchor, sorter=by_id)]
    floor, cap = _share(score, low, True), _share(score, high, False)
    open_ = floor <= cap
    for percent in [*[p for p in LADDER if low < p < high], low]:
        some = np.flatnonzero(open_)
        if not len(some):
            break
        some = some[np.argsort(owner[some], kind="stable")]
        used, owners = np.unique(owner[some], return_inverse=True)
        shared = spark.sparkContext.broadcast((
            block.take(used), order, owners, positive[some], score[some],
            _share(score[some], percent, True), cap[some],
        ))
        found = rows.mapInArrow(_negatives(shared, k), _RESULT)
        by = ["anchor_id", "positive_id"]
        found = materialize(_first(found, by, "negative_score", "negative_id", k), "hits")
        kept = found if percent == low else found.where(F.col("found") == k)
        kept.withColumn("rank", F.col("rank").cast("long")).drop("found").write.mode("append").parquet(out)
        full = found.where((F.col("found") == k) & (F.col("rank") == 1)).select(*by).toArrow()
        keys = set(zip(full.column(0).to_pylist(), full.column(1).to_pylist()))
        open_ &= np.array([pair not in keys for pair in zip(anchor.tolist(), positive.tolist())], bool)
        shared.destroy()
