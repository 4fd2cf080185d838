"""Tables that tasks fill and Spark merges: counts of hashed cells, and sets of hashes.

Who makes a table sizes it by counts and has another way where it would be too large to broadcast.
Hashes that share a cell only make it look fuller; who reads these tables must not depend on more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from faunagrid.llm.storage import arrow_map

SLICES = 64


def sliced(values: np.ndarray) -> tuple[list[int], list[bytes]]:
    """A table as numbered slices."""
    return list(range(SLICES)), [x.tobytes() for x in values.reshape(SLICES, -1)]


def merged(rows: DataFrame, kind: str, combine: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int, wide: str | None = None) -> np.ndarray:
    """One table of ``wide`` cells from rows (slice, cells of ``kind``): slices are dealt to tasks, each of which keeps one at a time."""
    wide = wide or kind

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            for own, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(cells, kind).astype(wide)
                if own == at:
                    held = combine(held, values)
                    continue
                if at is not None:
                    yield pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "cells": pa.array([held.tobytes()], pa.binary())})
                at, held = own, values
        if at is not None:
            yield pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "cells": pa.array([held.tobytes()], pa.binary())})

    dealt = rows.select("slice", "cells").repartition("slice").sortWithinPartitions("slice")
    found = {r.slice: r.cells for r in arrow_map(dealt, merge, "slice int, cells binary").collect()}  # SLICES rows
    out = np.zeros(size, wide)
    for own, cells in found.items():
        out.reshape(SLICES, -1)[own] = np.frombuffer(cells, wide)
    return out


#: Bits that each hash sets: a few, so that false positives are the product of chances.
PROBES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def places(hashes: np.ndarray, log_bits: int) -> list[np.ndarray]:
    return [(hashes * m) >> np.uint64(64 - log_bits) for m in PROBES]


class Bits:
    """A set of 64-bit hashes, with false positives only."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.log_bits = len(bits).bit_length() + 2

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in places(hashes.astype(np.uint64), self.log_bits):
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
        return found

    @classmethod
    def of(cls, rows: DataFrame, log_bits: int, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> Bits:
        """The set of what ``hashes`` makes of the rows: arrays of 64-bit numbers."""
        size = 1 << log_bits - 3

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(size, np.uint8)
            some = False
            for own in hashes(batches):
                some |= own.size > 0
                for at in places(own.astype(np.uint64), log_bits):
                    np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
            if some:
                slices, cells = sliced(bits)
                yield pa.RecordBatch.from_pydict({"slice": pa.array(slices, pa.int32()), "cells": pa.array(cells, pa.binary())})

        return cls(merged(arrow_map(rows, fill, "slice int, cells binary"), "u1", np.bitwise_or, size))


def log_bits_for(n: int) -> int:
    """Bits of a table for ``n`` hashes, as a power of two: about 16 to 32 a hash, so that a few in 10,000 are falsely in it."""
    return max(13, (16 * n).bit_length())
