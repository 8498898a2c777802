"""Running queries against vectors block by block.

Each task compares the vectors it scans with all queries as one matrix product
and passes on only what can still be part of the answer. Query tables small
enough are sent to every task; larger ones are sent in chunks, one after the other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.plans.joins import estimated_bytes
from simsearch.plans.storage import materialize

# Queries sent whole to each task, in bytes, with the k best each of them keeps.
QUERY_BYTES = 32 * 1024 * 1024
# Chunks that larger query tables are cut into at most; beyond it chunks grow.
MOST_CHUNKS = 10_000
# Numbers a task holds at a time while it compares.
_CELLS = 2_000_000
# Hits a task passes on at a time.
_ANSWER_ROWS = 100_000
# Squared lengths between which single precision neither overflows nor loses what is small.
_SINGLE = 1e-20, 1e30
# Share of pairs left open by single precision from which on the pairs are compared in double.
_OPEN_SHARE = 1 / 16

Batch = tuple[np.ndarray, np.ndarray]
# (batches of (ids, matrix), query ids, query matrix) -> columns of the answer
Kernel = Callable[[Iterable[Batch], np.ndarray, np.ndarray], Iterator[list[np.ndarray]]]


def to_matrix(column, dtype=np.float64) -> np.ndarray:
    """Arrow lists of equal length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.unique(np.asarray(column.value_lengths()))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different length: {lengths.tolist()}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), lengths[0] if len(lengths) else 0)


def usable(ids: np.ndarray, matrix: np.ndarray) -> Batch:
    """The rows whose squared length is a finite number.

    A vector with a null, NaN or infinite element is at no distance from
    anything; it is left out alone, and so is one too long to be squared.
    """
    if matrix.dtype.kind != "f":
        return ids, matrix
    with np.errstate(over="ignore", invalid="ignore"):
        good = np.isfinite(np.einsum("ij,ij->i", matrix, matrix))
    return (ids, matrix) if good.all() else (ids[good], matrix[good])


def _batches(batches: Iterable[pa.RecordBatch], dtype) -> Iterator[Batch]:
    for batch in batches:
        if batch.num_rows:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            ids, matrix = usable(ids, to_matrix(batch.column(1), dtype))
            if len(ids):
                yield ids, matrix


def check_width(vectors: np.ndarray, queries: np.ndarray) -> None:
    if vectors.shape[1] != queries.shape[1]:
        raise ValueError(
            f"vectors of different length: {vectors.shape[1]} and {queries.shape[1]}"
        )


def run_blocks(
    vectors: DataFrame,
    queries: DataFrame,
    kernel: Kernel,
    schema: str,
    vector_col: str,
    query_col: str,
    dtype=np.float64,
    vec_id: str = "vec_id",
    qid: str = "qid",
    query_bytes: int = QUERY_BYTES,
    kept: int = 0,
) -> DataFrame:
    """Apply ``kernel`` to every vector block with every query.

    ``kept`` is how many rows a task remembers for each query; with the queries
    themselves they must stay within ``query_bytes``.
    """
    left = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector_col).alias("_v")).where(
        "_v is not null"
    )
    right = queries.select(F.col(qid).alias("qid"), F.col(query_col).alias("_q")).where(
        "_q is not null"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def output(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def compare(some: DataFrame) -> DataFrame | None:
        """The vectors against queries that fit a task; none if no query is usable."""
        table = some.toArrow()
        block = usable(table.column("qid").to_numpy(), to_matrix(table.column("_q"), dtype))
        if not len(block[0]):
            return None
        shared = vectors.sparkSession.sparkContext.broadcast(block)

        def scan(batches):
            qids, matrix = shared.value
            for columns in kernel(_batches(batches, dtype), qids, matrix):
                yield output(columns)

        return left.mapInArrow(scan, schema)

    empty = vectors.sparkSession.createDataFrame([], schema)
    size = estimated_bytes(right, per_row=kept * 24)
    if size <= query_bytes:
        found = compare(right)
        return empty if found is None else found
    # More queries are taken chunk by chunk: a scan of the vectors for each, and no shuffle of them.
    chunks = min(right.count(), math.ceil(size / max(1, query_bytes)), MOST_CHUNKS)
    numbered = materialize(
        right.withColumn("_chunk", F.pmod(F.xxhash64("qid"), F.lit(chunks)).cast("int")), "queries"
    )
    parts = empty
    for chunk in range(chunks):
        found = compare(numbered.where(F.col("_chunk") == chunk).drop("_chunk"))
        if found is not None:
            parts = parts.unionByName(materialize(found, "chunk"))
    return parts


class Best:
    """The k best vectors of each query so far, by key and then by id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.key = np.full((queries, k), np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.value = np.zeros((queries, k))

    def add(self, q: np.ndarray, key: np.ndarray, ids: np.ndarray, value: np.ndarray) -> None:
        """Take in single pairs: the query's number, and the vector's key, id and value."""
        kth, last = self.key[q, -1], self.ids[q, -1]
        better = (key < kth) | ((key == kth) & (ids < last))
        if not better.any():
            return
        own, at = np.unique(q[better], return_inverse=True)
        owner = np.concatenate([np.repeat(np.arange(len(own)), self.k), at])
        key = np.concatenate([self.key[own].ravel(), key[better]])
        ids = np.concatenate([self.ids[own].ravel(), ids[better]])
        value = np.concatenate([self.value[own].ravel(), value[better]])
        order = np.lexsort((ids, key, owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, np.arange(len(own)))[owner]
        order = order[place < self.k]
        self.key[own] = key[order].reshape(-1, self.k)
        self.ids[own] = ids[order].reshape(-1, self.k)
        self.value[own] = value[order].reshape(-1, self.k)

    def answer(self, qids: np.ndarray) -> Iterator[list[np.ndarray]]:
        """Columns query, id, key and value, for some queries at a time."""
        step = max(1, _ANSWER_ROWS // self.k)
        for start in range(0, len(qids), step):
            some = slice(start, start + step)
            found = np.isfinite(self.key[some])
            owner = np.broadcast_to(np.asarray(qids)[some, None], found.shape)
            yield [owner[found], self.ids[some][found], self.key[some][found], self.value[some][found]]


def query_slices(queries: int, per_query: int) -> Iterator[slice]:
    """Runs of queries whose comparison stays within the cell budget."""
    step = max(1, _CELLS // max(1, per_query))
    for start in range(0, queries, step):
        yield slice(start, min(start + step, queries))


def kth_smallest(key: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th smallest key; infinite for shorter rows."""
    if key.shape[1] < k:
        return np.full(len(key), np.inf)
    return np.partition(key, k - 1, axis=1)[:, k - 1].astype(np.float64)


def first_columns(key: np.ndarray, k: int) -> np.ndarray:
    """Columns enough for a bound of the k-th smallest key that leaves few open."""
    return key[:, : max(32 * k, 1024)]


def marked(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of what is true."""
    return np.divmod(np.flatnonzero(marks), max(1, marks.shape[1]))


class Screen:
    """Vectors made ready to meet queries: all squared distances come from one matrix product.

    Single precision is tried first. What it leaves open is computed exactly, or in
    double precision if that is much.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.longest = float(np.einsum("ij,ij->i", vectors, vectors).max(initial=0.0))
        self._ready: dict[type, np.ndarray] = {}

    def _product(self, queries: np.ndarray, q2: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances, and how far off a query's may be."""
        width = self.vectors.shape[1]
        if kind not in self._ready:
            right = np.empty((width + 2, len(self.vectors)), kind)
            right[:width] = -2.0 * self.vectors.T
            right[width] = np.einsum("ij,ij->i", self.vectors, self.vectors)
            right[width + 1] = 1
            self._ready[kind] = right
        left = np.empty((len(queries), width + 2), kind)
        left[:, :width] = queries
        left[:, width] = 1
        left[:, width + 1] = q2
        known = np.finfo(kind)
        error = 4 * (width + 8) * (float(known.eps) * (q2 + self.longest) + float(known.tiny))
        return left @ self._ready[kind], error

    def near(
        self, queries: np.ndarray, limit: np.ndarray, among: np.ndarray | None = None, k: int | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Query numbers, vector numbers and distances of pairs at most ``limit`` (one per query) apart.

        ``among`` marks the pairs that count. With ``k``, pairs that cannot be among a
        query's k nearest may be left out where there is no limit.
        """
        q2 = np.einsum("ij,ij->i", queries, queries)
        low, high = _SINGLE
        fits = low <= self.longest <= high and float(q2.max(initial=0.0)) <= high
        for kind in (np.float32, np.float64) if fits else (np.float64,):
            squares, error = self._product(queries, q2, kind)
            with np.errstate(over="ignore"):
                bound = limit**2
                if k is not None and np.isinf(limit).any():
                    rows = np.flatnonzero(np.isinf(limit))
                    if among is None:
                        some = first_columns(squares, k)[rows]
                    else:
                        some = np.where(among[rows], squares[rows], kind(np.inf))
                    bound[rows] = kth_smallest(some, k) + error[rows]
                bound = np.nextafter((bound + error).astype(kind), kind(np.inf))
            near = squares <= bound[:, None]
            if among is not None:
                near &= among
            if kind is np.float64 or np.count_nonzero(near) <= _OPEN_SHARE * near.size:
                break
        q, v = marked(near)
        del squares, near
        for part in query_slices(len(q), self.vectors.shape[1]):
            distance = lengths(self.vectors[v[part]] - queries[q[part]])
            kept = distance <= limit[q[part]]
            if kept.any():
                yield q[part][kept], v[part][kept], distance[kept]


def squared_distances(vectors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one matrix product, and how far off each of them may be."""
    v2 = np.einsum("ij,ij->i", vectors, vectors)
    q2 = np.einsum("ij,ij->i", queries, queries)
    lengths = q2[:, None] + v2[None, :]
    squares = lengths - 2.0 * (queries @ vectors.T)
    return squares, (vectors.shape[1] + 4) * 4 * np.finfo(np.float64).eps * lengths


def lengths(gaps: np.ndarray) -> np.ndarray:
    """Lengths of the rows; the one way distances are computed, so that equal ones compare equal."""
    return np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
