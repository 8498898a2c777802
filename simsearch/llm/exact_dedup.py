"""Exact duplicates by content-defined chunk recipes.

A text without white space is cut where a rolling hash of its last 32 bytes
says so, so equal stretches give equal chunks wherever they stand. A chunk's
identifier is a 128-bit digest, verified by grouping the chunks themselves:
each distinct chunk moves once per task that holds it, however many documents
it is part of. Documents are then compared by their ordered identifier lists,
about a hundredth of their text; the texts themselves stay where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.rows import KEY, one_of_twins, with_key, without
from simsearch.llm.texts import IS_SPACE, pieces, utf8
from simsearch.plans.storage import materialize

SMALLEST, LARGEST = 256, 16_384
# Chunks end where these bits of the rolling hash are zero: every 1024 bytes or so.
BOUNDARY = np.uint32(0xFFC00000)
_ROLL = 32
_GEAR = np.frombuffer(hashlib.shake_128(b"chunk boundaries").digest(1024), np.uint32)


def boundaries(raw: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last 32 bytes asks for a cut."""
    rolled = _GEAR[raw]
    width = 1
    while width < _ROLL:
        longer = rolled.copy()
        longer[width:] += rolled[:-width] << np.uint32(width)
        rolled, width = longer, 2 * width
    return np.flatnonzero((rolled & BOUNDARY) == 0) + 1


def cut(start: int, end: int, wanted: np.ndarray) -> list[tuple[int, int]]:
    """Chunks of one text at raw[start:end]; a cut depends on bytes of this text only."""
    if start == end:
        return []
    chunks, last = [], start
    inside = wanted[np.searchsorted(wanted, start + SMALLEST):np.searchsorted(wanted, end)]
    for place in [*inside.tolist(), end]:
        while place - last > LARGEST:
            chunks.append((last, last + LARGEST))
            last += LARGEST
        if place - last >= SMALLEST or place == end:
            chunks.append((last, place))
            last = place
    return [c for c in chunks if c[0] < c[1]]


def _normalised(batch: pa.RecordBatch):
    raw, at = utf8(batch.column("text"))
    keep = ~IS_SPACE[raw]
    kept = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    points = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    return raw[keep], kept[at], np.diff(points[at])


def _recipes(seed: int, with_chunks: bool):
    key = seed.to_bytes(8, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            raw, at, points = _normalised(batch)
            wanted, data = boundaries(raw), raw.tobytes()
            bounds = at.tolist()
            recipes, digests, chunks = [], [], []
            for start, end in zip(bounds, bounds[1:]):
                own = [data[a:b] for a, b in cut(start, end, wanted)]
                ids = [hashlib.blake2b(c, digest_size=16, key=key).digest() for c in own]
                if with_chunks:
                    chunks += zip(ids, own)
                else:
                    recipes.append(b"".join(ids))
                    digests.append(hashlib.sha256(data[start:end]).digest())
            if with_chunks:
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array([i for i, _ in chunks], pa.binary()),
                    "chunk": pa.array([c for _, c in chunks], pa.binary()),
                })
            else:
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "_k1": batch.column("_k1"),
                    "_k2": batch.column("_k2"), "points": pa.array(points),
                    "digest": pa.array(digests, pa.binary()),
                    "recipe": pa.array(recipes, pa.binary()),
                })

    return run


def verified_seed(texts: DataFrame, seed: int = 0) -> int:
    """First seed from ``seed`` on under which no two different chunks share an identifier."""
    while True:
        chunks = texts.mapInArrow(_recipes(seed, True), "id binary, chunk binary").distinct()
        shared = chunks.groupBy("id").count().where("count > 1")
        if shared.isEmpty():
            return seed
        seed += 1


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every row with its group of equal texts, white space left out of account.

    Reads ``doc_id, text``; other columns are ignored. A null text is empty, and
    all empty texts are one group. Of a group the row with the most code points
    stays, then the smallest doc_id (null last); of rows that agree in both, one.
    Returns doc_id, keep_id, group_size, kept, text_sha256 and the row key.
    An empty table gives no rows.
    """
    texts = with_key(docs.select("doc_id", "text"))
    seed = verified_seed(texts.select("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    facts = texts.mapInArrow(
        _recipes(seed, False),
        f"doc_id {id_type}, _k1 long, _k2 long, points long, digest binary, recipe binary",
    )
    facts = materialize(facts.withColumn("_row", F.monotonically_increasing_id()), "recipes")
    best = F.struct(
        (-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"),
        F.col("doc_id").alias("doc_id"), F.col("_row").alias("_row"),
    )
    groups = facts.groupBy("recipe").agg(F.min(best).alias("best"), F.count("*").alias("n"))
    # Written first, so that the join below has a plain scan on either side and a
    # recipe that holds a large share of the rows can be split over tasks.
    groups = materialize(
        groups.where("n > 1").select(
            "recipe", "n", F.col("best.doc_id").alias("keep"), F.col("best._row").alias("keep_row")
        ),
        "groups",
    )
    found = facts.join(groups, "recipe", "left")
    alone = F.col("n").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *KEY,
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; twins count as one row."""
    groups = exact_groups(docs).groupBy(*KEY).agg(
        F.max("kept").alias("kept"), F.count("*").alias("n")
    )
    groups = materialize(groups.where("not kept or n > 1"), "decisions")
    rest = without(docs, groups.where("not kept"))
    return one_of_twins(rest, groups.where("kept").select(*KEY))
