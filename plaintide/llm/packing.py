"""Packing by best-fit decreasing: documents as token ids, cut into pieces and placed in windows of one size.

A document longer than the window is first cut into full windows; what remains is a piece below the window
size. Pieces are placed largest first, each into the open window with the least room that still takes it. A
segment tree over the possible remaining capacities, with the number of open windows at each leaf, finds that
capacity in a logarithmic number of steps.

Every task packs what it reads, PIECES remainders at a time, so nothing is shuffled, a hot source or a very long
document changes nothing, and memory is bounded by PIECES windows. A task that is run again gives the same rows:
sequence ids are the partition's number and a counter.

Equal lengths are placed in the order they come, into the window of the least room that was opened or filled last.
A null text counts as empty; an empty text is its end id alone. Rows that share an id are packed each. An empty
table gives no pieces; extra columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.llm.byte_bpe import encoding
from plaintide.llm.shared import ship_package

WINDOW = 1024
PIECES = 1 << 14
END = 0
#: Characters of text taken from a batch at a time.
TEXTS = 1 << 20


class Encoder:
    """Token ids of a byte-level BPE tokenizer; texts with a special token's string go through the library that knows them.

    A text is encoded whole: looking its words up costs more than their encoding does.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = encoding(path).encode_to_numpy
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if any(s in text for s in self.special):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.plain(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def text_groups(column: pa.Array, size: int = TEXTS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about ``size`` characters; null is empty."""
    lengths = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield a, ["" if t is None else t for t in column[a:b].to_pylist()]


class Capacities:
    """A segment tree of how many open windows have each remaining capacity."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def push(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self.change(capacity, 1)

    def tightest(self, length: int) -> int | None:
        """Take the open window with the least capacity of at least ``length``: its capacity."""
        node = length + self.leaves
        while not self.count[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves

    def pop(self, capacity: int) -> int:
        self.change(capacity, -1)
        return self.open[capacity].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """(window, offset) of each piece, all below the window size, and the number of windows."""
    tree, used = Capacities(window), 0
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.tightest(lengths[i])
        if room is None:
            room, where[i], used = window, used, used + 1
        else:
            where[i] = tree.pop(room)
        offset[i] = window - room
        if room > lengths[i]:
            tree.push(room - lengths[i], where[i])
    return where, offset, used


PIECE = pa.schema([
    ("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def packer(path: str, window: int, pieces: int):
    end = np.asarray([END], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        sequence = TaskContext.get().partitionId() << 36
        rests: list[tuple] = []

        def table(found: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), PIECE, strict=True)], schema=PIECE)

        def placed() -> pa.RecordBatch:
            nonlocal sequence
            where, offset, used = best_fit([r[2] for r in rests], window)
            found = [(*r, sequence + w, o) for r, w, o in zip(rests, where, offset, strict=True)]
            sequence += used
            rests.clear()
            return table(found)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in text_groups(batch.column(1)):
                full = []
                for row, raw in enumerate(map(own.encode, texts), first):
                    raw += end
                    total = len(raw) // 4
                    for start in range(0, total - window + 1, window):
                        full.append((ids[row], start, window, raw[4 * start : 4 * (start + window)], total, sequence, 0))
                        sequence += 1
                    if rest := total % window:
                        rests.append((ids[row], total - rest, rest, raw[4 * (total - rest) :], total))
                if full:
                    yield table(full)
                while len(rests) >= pieces:
                    yield placed()
        if rests:
            yield placed()

    return rows


def pack(documents: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", window: int = WINDOW, pieces: int = PIECES) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col(id).cast("long"), F.col(text).alias("text"))
    schema = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(packer(tokenizer, window, pieces), schema).withColumnRenamed("id", id)


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """(sequence_id, ids, padding): the ids of each window joined; a group is one window at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("filled"), parts.alias("parts"))
    power = F.col("filled").bitwiseAND(F.col("filled") - 1) == 0
    return whole.select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.when(power, 0).otherwise(window - F.col("filled")).alias("padding"),
    )
