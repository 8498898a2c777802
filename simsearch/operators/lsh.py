"""Neighbours by sign bits: signatures, Hamming scan, re-ranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.functions.vectors import l2_distance
from simsearch.operators.blocks import (
    QUERY_BYTES,
    Best,
    check_width,
    first_columns,
    kth_smallest,
    lengths,
    marked,
    query_slices,
    run_blocks,
    to_matrix,
    usable,
)
from simsearch.operators.search import top_k
from simsearch.plans.joins import lookup_join
from simsearch.plans.storage import materialize

SEED = 42
_HITS = "qid long, vec_id long, hamming double, distance double"


def hyperplanes(nbits: int, dim: int, seed: int = SEED) -> np.ndarray:
    """``nbits`` random hyperplanes of +1 and -1, the same for the same seed."""
    if nbits <= 0:
        raise ValueError("nbits must be positive")
    return np.random.RandomState(seed).randint(0, 2, size=(nbits, dim)) * 2 - 1


def sign_words(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Sign bits of each vector, 64 to a word, the first plane lowest."""
    bits = vectors @ planes.T.astype(np.float64) >= 0
    packed = np.packbits(bits, axis=1, bitorder="little")
    padded = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.int64)


def lsh_signature(
    vectors: DataFrame,
    nbits: int = 128,
    seed: int = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Rows ``(id, signature)``, the signature as an array of 64-bit words.

    A vector with a null, NaN or infinite element has none.
    """

    def sign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at, matrix = usable(np.arange(batch.num_rows), to_matrix(batch.column(1)))
            words = sign_words(matrix, hyperplanes(nbits, matrix.shape[1], seed))
            offsets = np.arange(0, words.size + 1, words.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.ravel()))
            ids = batch.column(0).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([ids, lists], [id_col, "signature"])

    rows = vectors.select(F.col(id_col).cast("long"), vector_col).where(
        F.col(vector_col).isNotNull()
    )
    return rows.mapInArrow(sign, f"{id_col} long, signature array<long>")


def _hamming(signatures: np.ndarray, queries: np.ndarray) -> np.ndarray:
    kind = np.uint16 if signatures.shape[1] < 1024 else np.uint32
    total = np.zeros((len(queries), len(signatures)), kind)
    # Bits of signed numbers would be counted on their absolute value.
    signatures, queries = signatures.view(np.uint64), queries.view(np.uint64)
    for word in range(signatures.shape[1]):
        total += np.bitwise_count(queries[:, word, None] ^ signatures[None, :, word])
    return total


def _near_codes(signatures: np.ndarray, queries: np.ndarray, best: Best, rows: slice):
    """Query numbers, signature numbers and bits of what may still enter ``best``, in parts."""
    bits = _hamming(signatures, queries[rows])
    bound = best.key[rows, -1].copy()
    none = np.flatnonzero(np.isinf(bound))
    if len(none):
        bound[none] = kth_smallest(first_columns(bits, best.k)[none], best.k)
    most = np.minimum(bound, np.iinfo(bits.dtype).max).astype(bits.dtype)
    q, v = marked(bits <= most[:, None])
    for part in query_slices(len(q), 64):
        yield q[part] + rows.start, v[part], bits[q[part], v[part]].astype(np.float64)


def _nearest_codes(k: int):
    def kernel(batches, qids, queries):
        best = Best(len(qids), k)
        for ids, signatures in batches:
            check_width(signatures, queries)
            for rows in query_slices(len(qids), len(ids)):
                for q, v, bits in _near_codes(signatures, queries, best, rows):
                    best.add(q, bits, ids[v], bits)
        yield from best.answer(qids)

    return kernel


def _nearest_signed(k: int, nbits: int, seed: int):
    """Signs, Hamming scan and true distances of the kept, in one pass."""

    def kernel(batches, qids, queries):
        best = Best(len(qids), k)
        planes = hyperplanes(nbits, queries.shape[1], seed)
        query_words = sign_words(queries, planes)
        for ids, vectors in batches:
            check_width(vectors, queries)
            words = sign_words(vectors, planes)
            for rows in query_slices(len(qids), len(ids)):
                for q, v, bits in _near_codes(words, query_words, best, rows):
                    for part in query_slices(len(q), vectors.shape[1]):
                        distance = lengths(vectors[v[part]] - queries[q[part]])
                        best.add(q[part], bits[part], ids[v[part]], distance)
        yield from best.answer(qids)

    return kernel


def _closest(hits: DataFrame, k: int) -> DataFrame:
    return top_k(hits, k, order=[F.col("hamming").asc(), F.col("vec_id").asc()])


def hamming_top_k(
    signatures: DataFrame,
    query_signatures: DataFrame,
    k: int = 10,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Rows ``(qid, rank, vec_id, hamming)`` by a scan of all signatures."""
    if k <= 0:
        raise ValueError("k must be positive")
    hits = run_blocks(
        signatures, query_signatures, _nearest_codes(k), _HITS, "signature", "signature",
        dtype=np.int64, query_bytes=query_bytes, kept=k,
    )
    return _closest(hits, k).select(
        "qid", F.col("rank").cast("long").alias("rank"), "vec_id",
        F.col("hamming").cast("long").alias("hamming"),
    )


def _by_distance(hits: DataFrame, k: int) -> DataFrame:
    ranked = top_k(
        hits.select("qid", "vec_id", "hamming", "distance"), k,
        order=[F.col("distance").asc(), F.col("vec_id").asc()],
    )
    return ranked.select(
        "qid", F.col("rank").cast("long").alias("rank"), "vec_id",
        F.col("hamming").cast("long").alias("hamming"), "distance",
    )


def knn_lsh(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    nbits: int = 128,
    seed: int = SEED,
    signatures: DataFrame | None = None,
    vector_col: str = "embedding",
    query_col: str = "q",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Rows ``(qid, rank, vec_id, hamming, distance)``.

    The k vectors with the nearest signatures, ordered by true distance. Stored
    ``signatures (vec_id, signature)`` of the same ``nbits`` and ``seed`` are
    scanned instead of the vectors, which then are read for the k hits only.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    if signatures is None:
        hits = run_blocks(
            vectors, queries, _nearest_signed(k, nbits, seed), _HITS, vector_col, query_col,
            query_bytes=query_bytes, kept=k,
        )
        return _by_distance(_closest(hits, k), k)
    signed = lsh_signature(queries, nbits, seed, "qid", query_col)
    hits = materialize(hamming_top_k(signatures, signed, k, query_bytes), "hits")
    ids = hits.select("vec_id").distinct()
    found = lookup_join(vectors.select("vec_id", vector_col), ids, ["vec_id"], "left_semi")
    joined = lookup_join(hits, found, ["vec_id"])
    joined = lookup_join(joined, queries.select("qid", query_col), ["qid"])
    distance = l2_distance(F.col(vector_col), F.col(query_col))
    return _by_distance(joined.withColumn("distance", distance), k)
