"""Scores of very many queries: a sparse product of query blocks and document ranges.

Queries are dealt to blocks and documents to ranges. A posting is copied once for each
block of queries that asks for its term, whatever number of them does, and meets the
block's weights in one cell. There it is scored document by document; a cell
passes on its k best of each query, so pairs of query and document are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.operators.index import Index
from simsearch.plans.joins import lookup_join
from simsearch.plans.storage import materialize

# Weights (a query's term) to a block of queries, postings to a cell, pairs added up at once.
BLOCK_WEIGHTS = 200_000
CELL_POSTINGS = 5_000_000
_PAIRS = 2_000_000

_SCORES = "qid long, doc_id long, dot double, similarity double"


class _Weights:
    """The weights of a block of queries, by term."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]]):
        term, qid, weight, norm = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((qid, term))
        self.terms, first = np.unique(term[order], return_index=True)
        self.start = np.append(first, len(order))
        self.qids, number = np.unique(qid, return_inverse=True)
        self.number, self.weight = number[order], weight[order]
        self.norm = np.zeros(len(self.qids))
        self.norm[number] = norm

    def scored(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(query number, doc, dot) of whole documents; the postings are in document order."""
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = self.terms[at] == term
        doc, at, wd = doc[known], at[known], np.log10(tf[known] + 1.0)
        counts = self.start[at + 1] - self.start[at]
        ends = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) + 1 if len(doc) else np.zeros(0, int)
        total = np.concatenate([[0], np.cumsum(counts)])
        begin = 0
        while begin < len(doc):
            # As many whole documents as stay within the bound, one at least.
            last = np.searchsorted(total[ends], total[begin] + _PAIRS, "right") - 1
            end = int(ends[max(last, np.searchsorted(ends, begin, "right"))])
            size = counts[begin:end]
            owner = np.repeat(np.arange(begin, end), size)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            place = self.start[at[owner]] + inside
            dots = wd[owner] * self.weight[place]
            order = np.lexsort((self.number[place], doc[owner]))
            d, q, dots = doc[owner][order], self.number[place][order], dots[order]
            new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (q[1:] != q[:-1])))
            yield q[new], d[new], np.add.reduceat(dots, new)
            begin = end

    def similarity(self, q: np.ndarray, dot: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.norm[q] != 0, dot / self.norm[q], 0.0)


def _first_k(q: np.ndarray, d: np.ndarray, dot: np.ndarray, similarity: np.ndarray, k: int):
    """The k best of each query; similarities that agree in twelve decimals go by the smaller id."""
    order = np.lexsort((d, -np.round(similarity, 12), q))
    starts = np.flatnonzero(np.append(True, q[order][1:] != q[order][:-1])) if len(q) else order
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    kept = order[place < k]
    return q[kept], d[kept], dot[kept], similarity[kept]


def _cells(k: int | None):
    """Score each cell: its weights come first, then its postings by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, weights = None, [], None
        rest = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]  # a document that may go on
        best: list[np.ndarray] | None = None

        def passed(q, d, dot, similarity):
            columns = (weights.qids[q], d, dot, similarity)
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=[f.split()[0] for f in _SCORES.split(", ")]
            )

        def add(doc, term, tf):
            nonlocal best
            for q, d, dot in weights.scored(doc, term, tf):
                found = (q, d, dot, weights.similarity(q, dot))
                if k is None:
                    yield passed(*found)
                else:
                    joined = found if best is None else [np.concatenate(c) for c in zip(best, found)]
                    best = _first_k(*joined, k)

        def done():
            nonlocal best, rest
            if weights is not None and len(rest[0]):
                yield from add(*rest)
            if best is not None:
                yield passed(*best)
            best, rest = None, [x[:0] for x in rest]

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("block", "range", "asks")])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            numbers = {c: batch.column(c).to_numpy() for c in ("id", "term", "value", "norm")}
            for start, end in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
                some = slice(start, end)
                if tuple(key[:2, start]) != cell:
                    yield from done()
                    cell, parts, weights = tuple(key[:2, start]), [], None
                if not key[2, start]:
                    parts.append(tuple(numbers[c][some] for c in ("term", "id", "value", "norm")))
                    continue
                if weights is None:
                    weights = _Weights(parts)
                doc, term, tf = (np.concatenate([r, numbers[c][some]]) for r, c in zip(rest, ("id", "term", "value")))
                whole = np.searchsorted(doc, doc[-1])
                rest = [doc[whole:], term[whole:], tf[whole:]]
                if whole:
                    yield from add(doc[:whole], term[:whole], tf[:whole])
        yield from done()

    return run


def blocked_scores(
    index: Index, weights: DataFrame, k: int | None = None,
    block_weights: int = BLOCK_WEIGHTS, cell_postings: int = CELL_POSTINGS,
) -> DataFrame:
    """Rows ``(qid, doc_id, dot, similarity)``: all of them, or each cell's ``k`` best of each query.

    ``weights`` is a table ``(qid, term, df, idf, wq, norm)``. The queries of a block
    and the postings of a cell are bounded by the sizes given, on average.
    """
    spark = weights.sparkSession
    rows = weights.count()
    blocks = max(1, math.ceil(rows / block_weights))
    block = F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("block")
    terms = weights.groupBy("term").agg(F.max("df").alias("df"))
    terms = materialize(terms.withColumn("number", F.monotonically_increasing_id()), "asked")
    own = lookup_join(weights.drop("df"), terms.select("term", "number"), ["term"], salt_by=["qid"])
    own = materialize(
        own.select(block, "number", "qid", (F.col("wq") * F.col("idf")).alias("value"), "norm"), "weights"
    )
    asking = materialize(own.select("block", "number").distinct(), "asking")
    copies = lookup_join(asking, terms.select("number", "df"), ["number"]).agg(
        F.coalesce(F.sum("df"), F.lit(0))
    ).first()[0]
    ranges = max(1, math.ceil(copies / blocks / cell_postings))
    held = lookup_join(index.postings, terms.select("term", "number"), ["term"], salt_by=["doc_id"])
    held = lookup_join(held.drop("term"), asking, ["number"], salt_by=["doc_id"]).select(
        "block", F.pmod(F.xxhash64("doc_id"), F.lit(ranges)).cast("int").alias("range"), F.lit(1).alias("asks"),
        F.col("doc_id").alias("id"), F.col("number").alias("term"), F.col("tf").cast("double").alias("value"),
        F.lit(0.0).alias("norm"),
    )
    own = own.withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1)))).select(
        "block", "range", F.lit(0).alias("asks"), F.col("qid").cast("long").alias("id"),
        F.col("number").alias("term"), "value", "norm",
    )
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.unionByName(held).repartition(max(session, min(blocks * ranges, 20_000)), "block", "range")
    return dealt.sortWithinPartitions("block", "range", "asks", "id").mapInArrow(_cells(k), _SCORES)
