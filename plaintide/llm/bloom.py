"""Bloom filters of a fixed size, built in tasks by segment and merged by Spark.

A filter has 2**bits bits and is cut into segments of SEGMENT bytes. A key sets PROBES bits. Its size is a
parameter, not a function of the rows, so a filter may be broadcast whatever the input; a fuller filter lets
more keys pass, and what passes is confirmed by its user.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
PROBES = 3
SEGMENT = 1 << 16
LEAST, MOST = 20, 28


def bits_for(keys: int, most: int = MOST) -> int:
    """Twelve to twenty-four bits a key, within the bound: 2**28 bits are 32 MB."""
    return min(max(LEAST, int(12 * max(keys, 1)).bit_length()), most)


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers, one row per probe; keys are mixed 64-bit hashes."""
    keys = keys.astype(U64, copy=False)
    step = (keys >> U64(32)) | U64(1)
    low = keys & U64(0xFFFFFFFF)
    return np.stack([((low + U64(i) * step) * U64(0x9E3779B97F4A7C15)) >> U64(64 - bits) for i in range(PROBES)])


class Bits:
    """The bits of one filter as bytes."""

    def __init__(self, bits: int, data: bytes | None = None) -> None:
        self.bits = bits
        self.data = np.zeros(1 << (bits - 3), np.uint8) if data is None else np.frombuffer(data, np.uint8)

    def add(self, keys: np.ndarray) -> None:
        at = places(keys, self.bits).ravel()
        np.bitwise_or.at(self.data, (at >> U64(3)).astype(np.int64), np.left_shift(1, at & U64(7)).astype(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = places(keys, self.bits)
        hit = (self.data[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1
        return hit.all(0)

    def segments(self) -> Iterator[tuple[int, bytes]]:
        for i in range(0, len(self.data), SEGMENT):
            part = self.data[i : i + SEGMENT]
            if part.any():
                yield i // SEGMENT, part.tobytes()


def union_of(keys: DataFrame, bits: int) -> bytes:
    """The bytes of a filter over the single long column of ``keys``; at most 2**MOST bits reach the driver."""
    column = keys.columns[0]

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bits(bits)
        for batch in batches:
            own.add(batch.column(0).to_numpy(zero_copy_only=False).view(U64))
        for number, part in own.segments():
            yield pa.record_batch([pa.array([number], pa.int64()), pa.array([part])], names=["segment", "part"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits_ = np.frombuffer(part, np.uint8)
                whole[number] = whole[number] | bits_ if number in whole else bits_
        if whole:
            parts_ = [pa.array([w.tobytes()]) for w in whole.values()]
            yield pa.record_batch([pa.array(list(whole), pa.int64()), pa.concat_arrays(parts_)], names=["segment", "part"])

    parts = keys.select(F.col(column)).mapInArrow(built, "segment long, part binary")
    rows = parts.repartition("segment").mapInArrow(merged, "segment long, part binary").collect()
    data = bytearray(1 << (bits - 3))
    for row in rows:
        data[row.segment * SEGMENT : row.segment * SEGMENT + len(row.part)] = row.part
    return bytes(data)
