"""Texts of an Arrow column as byte arrays: documents, words, lines and their hashes, a block at a time.

A block holds whole documents, about BLOCK bytes of them; a longer document is a block of its own. Hashes are two
polynomials modulo the prime 2**31 - 1 over random values, taken from prefix sums, so the hash of any span costs two
reads; a final mixing step makes all bits usable. Modulo a prime no structure of a text makes two hashes equal,
as it does modulo a power of two (words that are sums of alternating signs, such as Thue and Morse's); still, who
decides by equal hashes compares the bytes behind them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
U64 = np.uint64
PRIME = U64((1 << 31) - 1)
STEPS = (1_389_671_077, 0x5DEECE66 | 1)
BACKS = tuple(pow(step, -1, (1 << 31) - 1) for step in STEPS)
BYTES = np.random.default_rng(2).integers(1, (1 << 31) - 1, (2, 256), dtype=U64)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CODE_POINT = (np.arange(256) & 0xC0) != 0x80

_powers: dict[int, np.ndarray] = {}


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x below 2**63; the prime itself may stand for 0."""
    x = (x & PRIME) + (x >> U64(31))
    return (x & PRIME) + (x >> U64(31))


def powers(base: int, size: int) -> np.ndarray:
    """base**0, base**1, … modulo PRIME; kept for the usual block, made anew for a longer one."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.ones(max(size, BLOCK + 4096), U64)
        done = 1
        while done < len(have):
            more = have[: min(done, len(have) - done)] * U64(pow(base, done, int(PRIME)))
            have[done : done + len(more)] = reduced(more)
            done += len(more)
        if size <= BLOCK + 4096:
            _powers[base] = have
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """Every output bit depends on every input bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class SpanHash:
    """Hashes of spans of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray) -> None:
        self.fill(((values >> U64(31 * k)) & PRIME for k in range(2)), len(values))

    @classmethod
    def of_bytes(cls, data: np.ndarray) -> SpanHash:
        new = cls.__new__(cls)
        new.fill((table[data] for table in BYTES), len(data))
        return new

    def fill(self, values: Iterable[np.ndarray], size: int) -> None:
        """Plain sums of values below 2**31 times powers, each below 2**32, so a difference of sums is exact. The values are overwritten."""
        self.sums = np.zeros((2, size + 1), U64)
        for sums, part, step in zip(self.sums, values, STEPS, strict=True):
            part *= powers(step, size)[:size]
            high = part >> U64(31)
            part &= PRIME
            part += high
            np.cumsum(part, out=sums[1:])
        self.back = [powers(back, size + 1) for back in BACKS]

    def between(self, start: np.ndarray | slice, end: np.ndarray | slice, length: np.ndarray) -> np.ndarray:
        parts = []
        for sums, back in zip(self.sums, self.back, strict=True):
            part = reduced(reduced(sums[end] - sums[start]) * back[: len(sums)][start])
            part[part >= PRIME] -= PRIME
            parts.append(part)
        return mixed((parts[0] << U64(31) | parts[1]) ^ (length << U64(62)) ^ mixed(length))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.between(start, end, (end - start).astype(U64))

    def rolling(self, width: int) -> np.ndarray:
        """Hashes of all spans of one width, by their start."""
        count = max(0, self.sums.shape[1] - width)
        return self.between(slice(0, count), slice(width, width + count), np.array([width], U64))


def columns(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a string column; null is the empty text."""
    texts = pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8), ends


def blocks(batch: pa.RecordBatch, name: str, size: int = BLOCK) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of one block after another; offsets begin at 0."""
    if not batch.num_rows:
        return
    data, ends = columns(batch, name)
    row, last = 0, len(ends) - 1
    while row < last:
        stop = int(np.searchsorted(ends, ends[row] + size, "right")) - 1
        stop = min(max(stop, row + 1), last)
        yield slice(row, stop), data[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


class Words:
    """Maximal runs of bytes other than the ASCII white space, within documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        solid = ~WHITE[data]
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= ~solid[:-1]
        closes[:-1] &= ~solid[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        opens[edges] = solid[edges]
        closes[edges - 1] = solid[edges - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.offsets = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.offsets)

    def documents(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def runs(doc_offsets: np.ndarray, width: int) -> np.ndarray:
    """Starts of all windows of ``width`` items that lie within one document."""
    counts = np.diff(doc_offsets)
    starts = np.arange(doc_offsets[-1])
    left = np.repeat(doc_offsets[1:], counts) - starts
    return starts[left >= width]


def out(names_and_values: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(names_and_values[f.name], f.type) for f in schema], schema=schema)
