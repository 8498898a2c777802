"""Count-min sketch that tells what may occur twice.

Every task counts the hashes it sees in cells of its own sketch, which it passes
on slice by slice with counts of at most two; the slices are added up apart from
each other. A cell's count is at least that of each hash in it, so what occurs
twice is never missed; what shares its cells with others is overestimated.

The merged sketch is one bit per cell. Its width grows with the input up to
MAX_BITS (32 MiB in all), which bounds what is broadcast: beyond that more is
overestimated, and the exact pass behind it has more to do, but nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from simsearch.llm.words import mix

SLICE_BITS = 20
MAX_BITS = 28
PARTS = "slice int, cells binary"
# Hashes a task holds before it passes them on.
HELD = 1_000_000


def width_bits(items: float, rows: int) -> int:
    """Bits of a cell number so that about four cells come to an item, within the bound."""
    wanted = int(np.ceil(np.log2(max(4 * items, 1))))
    return min(max(wanted, SLICE_BITS), MAX_BITS - (rows - 1))


def _cells(hashes: np.ndarray, bits: int, row: int) -> np.ndarray:
    spread = mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % 2**64))
    return (spread >> np.uint64(64 - bits)).astype(np.int64)


def _encode(cells: np.ndarray) -> bytes:
    """Sorted cell numbers as their distances, in units of at most 254 and skips of 255."""
    steps = np.diff(cells, prepend=0)
    skips = steps // 255
    out = np.full(len(steps) + int(skips.sum()), 255, np.uint8)
    out[np.cumsum(skips + 1) - 1] = steps % 255
    return out.tobytes()


def _decode(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def partition_sketch(hashes: np.ndarray, bits: int, rows: int) -> pa.RecordBatch:
    """Slices of one sketch of ``hashes``: a cell is listed once, or twice if it counts more."""
    numbers, parts = [], []
    for row in range(rows):
        cells = np.sort(_cells(hashes, bits, row))
        keep = np.ones(len(cells), bool)
        keep[2:] = cells[2:] != cells[:-2]
        cells = cells[keep]
        edges = np.flatnonzero(np.diff(cells >> SLICE_BITS)) + 1
        for part in np.split(cells, edges) if len(cells) else ():
            number = int(part[0] >> SLICE_BITS)
            numbers.append((row << (bits - SLICE_BITS)) + number)
            parts.append(_encode(part - (number << SLICE_BITS)))
    return pa.RecordBatch.from_pydict(
        {"slice": pa.array(numbers, pa.int32()), "cells": pa.array(parts, pa.binary())}
    )


def sketched(hashes: Iterator[np.ndarray], bits: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Partition sketches of a task's hashes."""
    held, size = [], 0
    for some in hashes:
        held.append(some)
        size += len(some)
        if size >= HELD:
            yield partition_sketch(np.concatenate(held), bits, rows)
            held, size = [], 0
    if size:
        yield partition_sketch(np.concatenate(held), bits, rows)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the parts of each slice; they come slice after slice."""
    current, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_pydict({
            "slice": pa.array([current], pa.int32()),
            "cells": pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary()),
        })

    for batch in batches:
        for number, data in zip(batch.column("slice").to_pylist(), batch.column("cells").to_pylist()):
            if number != current:
                if current is not None and twice.any():
                    yield done()
                current = number
                once, twice = np.zeros(1 << SLICE_BITS, bool), np.zeros(1 << SLICE_BITS, bool)
            cells = _decode(data)
            twice[cells[once[cells]]] = True
            twice[cells[1:][cells[1:] == cells[:-1]]] = True
            once[cells] = True
    if current is not None and twice.any():
        yield done()


class Repeated:
    """The merged sketch: which hashes may have been counted twice or more."""

    def __init__(self, slices, bits: int, rows: int):
        self.bits, self.rows = bits, rows
        self.map = np.zeros((rows << bits) >> 3, np.uint8)
        size = 1 << (SLICE_BITS - 3)
        for number, cells in slices:
            self.map[number * size:(number + 1) * size] = np.frombuffer(cells, np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for row in range(self.rows):
            cells = _cells(hashes, self.bits, row) + (row << self.bits)
            found &= (self.map[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
        return found


def merged(parts: DataFrame, bits: int, rows: int) -> Repeated:
    """Merge partition sketches; at most 2**MAX_BITS bits come to the driver, whatever the input."""
    slices = (
        parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merge, PARTS).collect()
    )
    return Repeated([(r["slice"], r["cells"]) for r in slices], bits, rows)
