"""Exact nearest neighbours, range search and distances.

A vector or query with a null, NaN or infinite element is at no distance from
anything: it is in no answer, and takes no other vector with it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.operators.blocks import (
    QUERY_BYTES,
    Best,
    Screen,
    check_width,
    query_slices,
    run_blocks,
)
from simsearch.operators import pivots
from simsearch.operators.search import top_k
from simsearch.plans.joins import estimated_bytes, fits_broadcast, lookup_join
from simsearch.plans.storage import materialize

_HITS = "qid long, vec_id long, distance double, value double"
_PAIRS = "qid long, vec_id long, distance double"
# Query tables so many times too large for a task are dealt to cells, unless more than such a
# share of all pairs has to be compared anyway: then scans of the vectors move less.
FEW_SCANS, MOST_SHARE = 64, 0.5


def _nearest(k: int):
    def kernel(batches, qids, queries):
        best = Best(len(qids), k)
        for ids, vectors in batches:
            check_width(vectors, queries)
            screen = Screen(vectors)
            for rows in query_slices(len(qids), len(ids)):
                for q, v, distance in screen.near(queries[rows], best.key[rows, -1], k=k):
                    best.add(q + rows.start, distance, ids[v], distance)
        yield from best.answer(qids)

    return kernel


def _within(radius: float | None):
    """Keep pairs at most ``radius`` apart; the last query column without one."""

    def kernel(batches, qids, queries):
        limit = np.full(len(qids), radius) if radius is not None else queries[:, -1]
        points = queries if radius is not None else queries[:, :-1]
        for ids, vectors in batches:
            check_width(vectors, points)
            screen = Screen(vectors)
            for rows in query_slices(len(qids), len(ids)):
                for q, v, distance in screen.near(points[rows], limit[rows]):
                    yield [qids[q + rows.start], ids[v], distance]

    return kernel


def _merged(hits: DataFrame, k: int) -> DataFrame:
    best = top_k(hits, k, order=[F.col("distance").asc(), F.col("vec_id").asc()])
    return best.select("qid", F.col("rank").cast("long").alias("rank"), "vec_id", "distance")


def _share_of_pairs(queries: DataFrame, query_col: str, query_bytes: int, kept: int) -> float | None:
    """The share of pairs up to which cells pay; none if the queries fit a task."""
    held = queries.select("qid", query_col).where(F.col(query_col).isNotNull())
    size = estimated_bytes(held, per_row=kept * 24)
    if size <= query_bytes:
        return None
    return MOST_SHARE if size <= FEW_SCANS * query_bytes else 1.0


def knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vector_col: str = "embedding",
    query_col: str = "q",
    query_bytes: int = QUERY_BYTES,
    cell_rows: int = pivots.CELL_ROWS,
) -> DataFrame:
    """Rows ``(qid, rank, vec_id, distance)``: the k nearest, ties to the smaller id.

    Queries of more than ``query_bytes`` are dealt to cells of about ``cell_rows`` vectors.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    share = _share_of_pairs(queries, query_col, query_bytes, k)
    if share is not None:
        hits, _ = pivots.nearest(vectors, queries, k, vector_col, query_col, share, cell_rows)
        if hits is not None:
            return _merged(hits, k)
    hits = run_blocks(
        vectors, queries, _nearest(k), _HITS, vector_col, query_col,
        query_bytes=query_bytes, kept=k,
    )
    return _merged(hits, k)


def range_search(
    vectors: DataFrame,
    queries: DataFrame,
    radius: float,
    vector_col: str = "embedding",
    query_col: str = "q",
    query_bytes: int = QUERY_BYTES,
    cell_rows: int = pivots.CELL_ROWS,
) -> DataFrame:
    """Rows ``(qid, vec_id, distance)`` with distance at most ``radius``; see ``knn`` for many queries."""
    if radius < 0:
        raise ValueError("radius must not be negative")
    share = _share_of_pairs(queries, query_col, query_bytes, 0)
    if share is not None:
        bounded = queries.select("qid", query_col).withColumn("_radius", F.lit(float(radius)))
        hits, _ = pivots.within(vectors, bounded, vector_col, query_col, "_radius", share, cell_rows)
        if hits is not None:
            return hits
    return run_blocks(
        vectors, queries, _within(float(radius)), _PAIRS, vector_col, query_col,
        query_bytes=query_bytes,
    )


def knn_with_ties(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vector_col: str = "embedding",
    query_col: str = "q",
    query_bytes: int = QUERY_BYTES,
    cell_rows: int = pivots.CELL_ROWS,
) -> DataFrame:
    """Rows ``(qid, vec_id, distance)``: the k nearest and all as near as the k-th.

    The k nearest give each query its own radius, and a range search finds
    everything within it: equally near copies stay where they are scanned, however
    many there are.
    """
    nearest = knn(vectors, queries, k, vector_col, query_col, query_bytes, cell_rows)
    radius = nearest.groupBy("qid").agg(F.max("distance").alias("_radius"))
    # A radius per query is no larger than the queries themselves.
    small = fits_broadcast(queries.select("qid", query_col), query_bytes)
    bounded = lookup_join(queries.select("qid", query_col), radius, ["qid"], broadcast=small)
    share = _share_of_pairs(queries, query_col, query_bytes, 0)
    if share is not None:
        bounded = materialize(bounded, "radius")
        hits, _ = pivots.within(vectors, bounded, vector_col, query_col, "_radius", share, cell_rows)
        if hits is not None:
            return hits
    bounded = bounded.select(
        "qid",
        F.concat(
            F.transform(query_col, lambda x: x.cast("double")), F.array("_radius")
        ).alias(query_col),
    )
    bounded = materialize(bounded, "radius")
    return run_blocks(
        vectors, bounded, _within(None), _PAIRS, vector_col, query_col, query_bytes=query_bytes
    )


def distances(
    vectors: DataFrame,
    queries: DataFrame,
    vector_col: str = "embedding",
    query_col: str = "q",
) -> DataFrame:
    """Rows ``(qid, vec_id, distance)`` of every vector to each query.

    The answer has a row per pair; it is meant for the one query, or the few,
    whose distances are looked at.
    """
    return run_blocks(
        vectors, queries, _within(float("inf")), _PAIRS, vector_col, query_col
    )


def attach_tracks(
    hits: DataFrame,
    tracks: DataFrame,
    track_id: str,
    columns: list[str],
    hit_id: str = "vec_id",
) -> DataFrame:
    """Hits that have a track, with the given columns of it.

    Ids are compared as numbers, so '037156' finds track 37156.
    """
    known = tracks.select(F.col(track_id).cast("long").alias("_track"), *columns)
    keyed = materialize(hits.withColumn("_track", F.col(hit_id).cast("long")), "hits")
    if fits_broadcast(keyed):
        joined = lookup_join(known, keyed, ["_track"], broadcast=True)
    else:
        joined = lookup_join(keyed, known, ["_track"])
    return joined.select(*hits.columns, *columns)
