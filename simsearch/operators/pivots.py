"""Neighbours for large tables of queries: both sides dealt to cells around pivots.

Pivots are vectors themselves; a vector belongs to the cell of its nearest one. What
a cell holds lies in a ring around its pivot and on its own side of the plane
between two pivots, so by the triangle inequality a query within a known distance of
its answers need not see most cells. The k nearest first see the cells closest to
them, which gives that distance; a range search knows it. What has to be seen is counted
before anything moves. Small cells share a bin, to which a query travels once, with a bit
for each cell it has to see there. Groups have a bounded size: a cell with many vectors, or
a bin that many queries ask for, is several groups. Nothing passes the driver but
the pivots and a few numbers per cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.operators.blocks import (
    Best,
    Screen,
    check_width,
    lengths,
    query_slices,
    squared_distances,
    to_matrix,
    usable,
)
from simsearch.operators.search import top_k
from simsearch.plans.joins import lookup_join
from simsearch.plans.storage import materialize

# Vectors to a cell on average, and to a group at most; queries to a group at most.
CELL_ROWS = 8192
GROUP_ROWS = 16_384
GROUP_QUERIES = 1 << 16
MOST_PIVOTS = 1024
# Pairs of vector and query that a task compares.
TASK_PAIRS = 500_000_000
MOST_TASKS = 20_000
# Rows a task passes on at a time. Cells of fewer vectors are compared together where so large a share
# of their pairs is wanted.
BATCH_ROWS = 8192
FEW_ROWS = 512
DENSE = 0.25

_HITS = "qid long, vec_id long, distance double"


@dataclass(frozen=True)
class Cells:
    """Pivots, the exact distance between any two, and what is known of each cell's vectors."""

    pivots: np.ndarray
    apart: np.ndarray
    rows: np.ndarray
    least: np.ndarray
    most: np.ndarray
    longest: float  # greatest squared length of a vector
    bins: np.ndarray  # of every cell; cells of a bin follow each other

    def doubt(self) -> float:
        """How far a vector may be from the right side of a plane, in squared distances."""
        own = float((self.pivots**2).sum(axis=1).max(initial=0.0))
        return 2 * (self.pivots.shape[1] + 4) * 4 * np.finfo(np.float64).eps * (own + self.longest)

    def closest(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Which cells, taken by the distance of their pivots, hold k vectors together."""
        squares, _ = squared_distances(self.pivots, queries)
        order = np.argsort(squares, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        found = np.zeros(squares.shape, bool)
        np.put_along_axis(found, order, (held < k) & (self.rows[order] > 0), axis=1)
        return found

    def within(self, queries: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Which cells may hold a vector at most ``radius`` away."""
        squares, error = squared_distances(self.pivots, queries)
        near, far = np.sqrt(np.maximum(squares - error, 0)), np.sqrt(squares + error)
        ring = np.maximum(near - self.most, self.least - far)
        home = squares.argmin(axis=1)
        own = np.take_along_axis(squares + error, home[:, None], axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (squares - error - own - self.doubt()) / (2 * self.apart[home])
        plane[np.arange(len(home)), home] = 0.0
        bound = np.maximum(ring, np.nan_to_num(plane, nan=0.0, posinf=0.0, neginf=0.0))
        return (bound <= radius[:, None] * (1 + 1e-9)) & (self.rows > 0)


def choose_pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """``count`` different vectors, by a hash of their ids, so that the choice is the same every time."""
    length = F.aggregate("_v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    # Unusable ones are looked out for only if there seems to be nothing else.
    for some in (vectors, vectors.where(length < F.lit(float("inf")))):
        table = some.orderBy(F.xxhash64("vec_id"), "vec_id").limit(count).select("vec_id", "_v").toArrow()
        if table.num_rows:
            _, matrix = usable(table.column("vec_id").to_numpy(), to_matrix(table.column("_v")))
            if len(matrix):
                return np.unique(matrix, axis=0)
    return np.zeros((0, 0))


def _placed(pivots: np.ndarray):
    """The cell of every usable vector, its distance to the pivot and its squared length."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = to_matrix(batch.column("_v"))
            check_width(pivots, matrix)
            at, matrix = usable(np.arange(len(matrix)), matrix)
            if not len(at):
                continue
            cell = np.empty(len(at), np.int32)
            for rows in query_slices(len(at), len(pivots)):
                cell[rows] = squared_distances(pivots, matrix[rows])[0].argmin(axis=1)
            kept = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [kept.column("vec_id"), kept.column("_v"), pa.array(cell), pa.array(lengths(matrix - pivots[cell])),
                 pa.array(np.einsum("ij,ij->i", matrix, matrix))],
                names=["vec_id", "_v", "cell", "far", "square"],
            )

    return place


def place(vectors: DataFrame, cell_rows: int) -> tuple[DataFrame, Cells] | None:
    """Table ``(vec_id, _v, cell, far, square)`` and its cells; none without a usable vector."""
    kind = vectors.schema["_v"].dataType.simpleString()
    pivots = choose_pivots(vectors, min(MOST_PIVOTS, max(1, math.ceil(vectors.count() / cell_rows))))
    if not len(pivots):
        return None
    placed = materialize(
        vectors.mapInArrow(
            _placed(pivots), f"vec_id long, _v {kind}, cell int, far double, square double"
        ),
        "placed",
    )
    rows, longest = np.zeros(len(pivots), np.int64), 0.0
    least, most = np.full(len(pivots), np.inf), np.zeros(len(pivots))
    facts = placed.groupBy("cell").agg(F.count("*"), F.min("far"), F.max("far"), F.max("square"))
    for cell, n, low, high, square in facts.collect():  # a row per pivot
        rows[cell], least[cell], most[cell] = n, low, high
        longest = max(longest, square)
    apart = np.stack([lengths(pivots - p) for p in pivots])
    return placed, Cells(pivots, apart, rows, least, most, longest, _bins(rows, GROUP_ROWS))


def _bins(rows: np.ndarray, most: int) -> np.ndarray:
    """Numbers of bins of at most so many vectors; a larger cell has its own."""
    found, held = np.zeros(len(rows), np.int32), 0
    for cell in range(1, len(rows)):
        held += int(rows[cell - 1])
        full = held + int(rows[cell]) > most
        found[cell] = found[cell - 1] + full
        held = 0 if full else held
    return found


def _homes(shared, k: int):
    """Every usable query with the closest cells that hold k vectors."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = to_matrix(batch.column("_q"))
            check_width(cells.pivots, matrix)
            at, matrix = usable(np.arange(len(matrix)), matrix)
            found: list[list[int]] = []
            for rows in query_slices(len(at), len(cells.pivots)):
                found += [np.flatnonzero(own).tolist() for own in cells.closest(matrix[rows], k)]
            kept = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [kept.column("qid"), kept.column("_q"), pa.array(found, pa.list_(pa.int32()))],
                names=["qid", "_q", "homes"],
            )

    return find


def _first(cells: Cells, matrix: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    """A query first sees its homes."""
    return _homes_marked(batch.column("homes"), len(matrix), len(cells.pivots))


def _rest(cells: Cells, matrix: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    """Then all cells within its radius, but for the homes."""
    radius = batch.column("radius").to_numpy(zero_copy_only=False)
    return cells.within(matrix, radius) & ~_homes_marked(batch.column("homes"), len(matrix), len(cells.pivots))


def _homes_marked(homes: pa.ListArray, rows: int, count: int) -> np.ndarray:
    found = np.zeros((rows, count), bool)
    owner = np.repeat(np.arange(rows), np.asarray(homes.value_lengths()))
    found[owner, homes.flatten().to_numpy()] = True
    return found


def _wanted(shared, wants, batches: Iterator[pa.RecordBatch]):
    """Cells, and usable queries in runs of bounded size with the cells they want."""
    cells = shared.value
    for batch in batches:
        if not batch.num_rows:
            continue
        matrix = to_matrix(batch.column("_q"))
        check_width(cells.pivots, matrix)
        at, matrix = usable(np.arange(len(matrix)), matrix)
        kept = batch.take(pa.array(at))
        for rows in query_slices(len(at), len(cells.pivots)):
            some = kept.slice(rows.start, rows.stop - rows.start)
            yield cells, some, wants(cells, matrix[rows], some)


def _counting(shared, wants):
    """How many queries want each cell, and each bin."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells, _, wanted in _wanted(shared, wants, batches):
            starts = np.flatnonzero(np.diff(cells.bins, prepend=-1))
            bins = np.logical_or.reduceat(wanted, starts, axis=1).sum(axis=0)
            counts = np.concatenate([wanted.sum(axis=0), bins])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(counts)) >= wanted.shape[1]),
                    pa.array(np.concatenate([np.arange(wanted.shape[1]), np.arange(len(starts))]).astype(np.int32)),
                    pa.array(counts.astype(np.int64)),
                ],
                names=["binned", "at", "n"],
            )

    return count


def _visiting(shared, wants):
    """A row for each query and bin it has to see, with a bit for each cell of the bin."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells, some, wanted in _wanted(shared, wants, batches):
            starts = np.flatnonzero(np.diff(cells.bins, prepend=-1))
            for number, (start, end) in enumerate(zip(starts, [*starts[1:], len(cells.bins)])):
                own = wanted[:, start:end]
                at = np.flatnonzero(own.any(axis=1))
                for first in range(0, len(at), BATCH_ROWS):
                    rows = at[first : first + BATCH_ROWS]
                    bits = np.packbits(own[rows], axis=1)
                    ends = np.arange(len(rows) + 1, dtype=np.int32) * bits.shape[1]
                    kept = some.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), number, np.int32)), kept.column("qid"), kept.column("_q"),
                            kept.column("radius"),
                            pa.Array.from_buffers(
                                pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(bits.tobytes())]
                            ),
                        ],
                        names=["bin", "qid", "_q", "radius", "bits"],
                    )

    return visit


# Query numbers, cells' vectors ready to be compared, their ids, and which of the pairs count.
Part = tuple[np.ndarray, Screen, np.ndarray, np.ndarray | None]


def _nearest(k: int):
    def compare(parts: Iterator[Part], qids, queries, radius):
        best = Best(len(qids), k)
        for rows, screen, ids, among in parts:
            limit = np.minimum(best.key[rows, -1], radius[rows])
            for q, v, distance in screen.near(queries[rows], limit, among, k):
                best.add(rows[q], distance, ids[v], distance)
        for columns in best.answer(qids):
            yield columns[:3]

    return compare


def _within():
    def compare(parts: Iterator[Part], qids, queries, radius):
        for rows, screen, ids, among in parts:
            for q, v, distance in screen.near(queries[rows], radius[rows], among):
                yield [qids[rows[q]], ids[v], distance]

    return compare


class _Group:
    """The vectors of a group, by cell."""

    def __init__(self, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        own, ids, matrix = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(own, kind="stable")
        self.own, self.ids, self.matrix = own[order], ids[order], matrix[order]
        self.cells, self.starts = np.unique(self.own, return_index=True)
        self.ends = np.append(self.starts[1:], len(own))
        self.screens: dict[int, Screen] = {}

    def _screen(self, cell: int, rows: slice) -> Screen:
        if cell not in self.screens:
            self.screens[cell] = Screen(self.matrix[rows])
        return self.screens[cell]

    def parts(self, wanted: np.ndarray) -> Iterator[Part]:
        """What has to be compared: cell by cell, or all at once where that is much of it."""
        wanted = wanted[:, self.cells]
        pairs = int(wanted.sum(axis=0) @ (self.ends - self.starts))
        few = len(self.ids) < FEW_ROWS * len(self.cells)
        if wanted.all() or few and pairs >= DENSE * len(wanted) * len(self.ids):
            screen = self._screen(-1, slice(None))
            column = np.repeat(np.arange(len(self.cells)), self.ends - self.starts)
            for some in query_slices(len(wanted), len(self.ids)):
                marks = wanted[some]
                yield np.arange(some.start, some.stop), screen, self.ids, None if marks.all() else marks[:, column]
            return
        for cell, (start, end) in enumerate(zip(self.starts, self.ends)):
            asking = np.flatnonzero(wanted[:, cell])
            for some in query_slices(len(asking), end - start):
                yield asking[some], self._screen(cell, slice(start, end)), self.ids[start:end], None


def _grouped(compare):
    """Run ``compare`` for every group: its vectors come first, then its queries, in any number of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, ready = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("bin", "part", "share", "asks")
            ])
            new = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
                some = batch.slice(start, end - start)
                key, asks = tuple(keys[:3, start]), keys[3, start]
                ids, matrix = some.column("id").to_numpy(), to_matrix(some.column("v"))
                if key != group:
                    group, held, ready = key, [], None
                if not asks:
                    held.append((some.column("own").to_numpy(), ids, matrix))
                    continue
                if ready is None and held:
                    ready, held = _Group(held), []
                if ready is None:
                    continue
                bits = some.column("bits")
                packed = np.frombuffer(b"".join(bits.to_pylist()), np.uint8).reshape(len(bits), -1)
                wanted = np.unpackbits(packed, axis=1).astype(bool)
                radius = some.column("radius").to_numpy(zero_copy_only=False)
                for columns in compare(ready.parts(wanted), ids, matrix, radius):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], names=["qid", "vec_id", "distance"]
                    )

    return run


def _join(
    placed: DataFrame, cells: Cells, shared, queries: DataFrame, wants, compare, most: float = math.inf
) -> tuple[DataFrame | None, int]:
    """Hits of the cells that ``(qid, _q, radius, homes)`` want, and the pairs compared for them; none if over ``most``."""
    spark = placed.sparkSession
    queries = queries.select("qid", "_q", "radius", "homes")
    counted = queries.mapInArrow(_counting(shared, wants), "binned boolean, at int, n long")
    counts = counted.groupBy("binned", "at").agg(F.sum("n").alias("n")).where("n > 0").collect()  # rows per pivot
    pairs = sum(int(cells.rows[r["at"]]) * r["n"] for r in counts if not r["binned"])
    if not pairs:
        return spark.createDataFrame([], _HITS), 0
    if pairs > most:
        return None, pairs
    # Parts a bin's vectors are cut into, and shares its queries are.
    held = np.bincount(cells.bins, weights=cells.rows)
    start = np.flatnonzero(np.diff(cells.bins, prepend=-1))
    plan = spark.createDataFrame(
        [
            (r["at"], int(start[r["at"]]), math.ceil(held[r["at"]] / GROUP_ROWS), math.ceil(r["n"] / GROUP_QUERIES))
            for r in counts if r["binned"]
        ],
        "bin int, start int, parts int, shares int",
    )
    homes = spark.createDataFrame([(c, int(b)) for c, b in enumerate(cells.bins)], "cell int, bin int")

    def spread(key: str, count: str):
        return F.pmod(F.xxhash64(key), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    vectors = placed.join(F.broadcast(homes.join(F.broadcast(plan), "bin")), "cell")
    vectors = vectors.withColumn("share", every("shares")).select(
        "bin", spread("vec_id", "parts").alias("part"), "share", F.lit(0).alias("asks"),
        (F.col("cell") - F.col("start")).alias("own"), F.lit(None).cast("binary").alias("bits"),
        F.col("vec_id").alias("id"), F.col("_v").alias("v"), F.lit(0.0).alias("radius"),
    )
    kind = queries.schema["_q"].dataType.simpleString()
    asked = queries.mapInArrow(
        _visiting(shared, wants), f"bin int, qid long, _q {kind}, radius double, bits binary"
    )
    asked = asked.join(F.broadcast(plan), "bin").withColumn("part", every("parts")).select(
        "bin", "part", spread("qid", "shares").alias("share"), F.lit(1).alias("asks"),
        F.lit(0).alias("own"), "bits", F.col("qid").alias("id"), F.col("_q").alias("v"), "radius",
    )
    if vectors.schema["v"].dataType != asked.schema["v"].dataType:
        vectors, asked = (x.withColumn("v", F.col("v").cast("array<double>")) for x in (vectors, asked))
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(session, min(MOST_TASKS, math.ceil(pairs / TASK_PAIRS)))
    group = ["bin", "part", "share"]
    dealt = vectors.unionByName(asked).repartition(tasks, *group).sortWithinPartitions(*group, "asks")
    return materialize(dealt.mapInArrow(_grouped(compare), _HITS), "hits"), pairs


def _named(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector_col).alias("_v")).where(
        "_v is not null"
    )


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, vector_col: str = "embedding", query_col: str = "q",
    most_share: float = 1.0, cell_rows: int = CELL_ROWS,
) -> tuple[DataFrame | None, int]:
    """Hits ``(qid, vec_id, distance)`` that hold the k nearest of every query, and the pairs compared.

    No hits are returned if more than ``most_share`` of all pairs would have to be compared.
    """
    spark = vectors.sparkSession
    found = place(_named(vectors, vector_col), cell_rows)
    if found is None:
        return spark.createDataFrame([], _HITS), 0
    placed, cells = found
    shared = spark.sparkContext.broadcast(cells)
    right = queries.select(F.col("qid").cast("long").alias("qid"), F.col(query_col).alias("_q"))
    kind = right.schema["_q"].dataType.simpleString()
    right = materialize(
        right.where("_q is not null").mapInArrow(_homes(shared, k), f"qid long, _q {kind}, homes array<int>"),
        "homes",
    )
    most = most_share * right.count() * int(cells.rows.sum())
    first = right.withColumn("radius", F.lit(float("inf")))
    hits, compared = _join(placed, cells, shared, first, _first, _nearest(k), most)
    if hits is None:
        return None, compared
    best = materialize(
        top_k(hits, k, order=[F.col("distance").asc(), F.col("vec_id").asc()]).drop("rank"), "best"
    )
    # The k-th best so far bounds the answer; where there are fewer, all vectors were seen.
    bound = best.groupBy("qid").agg(F.count("*").alias("n"), F.max("distance").alias("radius"))
    bounded = materialize(
        lookup_join(right, bound.where(F.col("n") >= k).drop("n"), ["qid"]), "bounded"
    )
    rest, more = _join(placed, cells, shared, bounded, _rest, _nearest(k), most)
    return None if rest is None else best.unionByName(rest), compared + more


def within(
    vectors: DataFrame, queries: DataFrame, vector_col: str = "embedding", query_col: str = "q",
    radius_col: str = "radius", most_share: float = 1.0, cell_rows: int = CELL_ROWS,
) -> tuple[DataFrame | None, int]:
    """Rows ``(qid, vec_id, distance)`` at most the query's radius apart, and the pairs compared.

    No rows are returned if more than ``most_share`` of all pairs would have to be compared.
    """
    spark = vectors.sparkSession
    found = place(_named(vectors, vector_col), cell_rows)
    if found is None:
        return spark.createDataFrame([], _HITS), 0
    placed, cells = found
    right = queries.select(
        F.col("qid").cast("long").alias("qid"), F.col(query_col).alias("_q"),
        F.col(radius_col).cast("double").alias("radius"), F.array().cast("array<int>").alias("homes"),
    ).where("_q is not null and radius is not null")
    most = most_share * right.count() * int(cells.rows.sum())
    return _join(placed, cells, spark.sparkContext.broadcast(cells), right, _rest, _within(), most)
