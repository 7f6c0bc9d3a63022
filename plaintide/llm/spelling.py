"""Spelling variants: words one edit apart, found by comparing code-point matrices in tiles.

1. Words. Runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts, A-Z lower-cased, are counted per batch in the tasks and
   summed by Spark, so a frequent word leaves each batch as one row.
2. Blocks. Two words one edit apart, the shorter of ``S`` code points, agree in a prefix and a suffix that leave an
   edit inside one of SEGMENTS segments of ``0..S``. Each word joins, as a word of length S and as one of length
   S + 1, one block per segment, keyed by what stands before and after the segment.
3. Tiles. A task packs blocks of like size and width into padded matrices and compares every row with every other.
   With the common prefix ``p`` and the common suffix ``q`` of two rows, ``p + q >= longer length - 1`` identifies
   one edit. A pair that meets in several blocks is taken in the first: the one whose segment begins at 0, or
   before the common suffix does.
4. Blocks above TILE words are not compared: their rows pass through and meet again with the segment halved. A
   block whose segment is one code point is compared whatever its size; the alphabet of 90 letters bounds it to
   90 words and 90 * 90 longer ones.

A word's form is the near word with the largest count (least in code-point order on a tie) if that has ``ratio``
times the word's count. Counts grow along forms, so they end in a root, which pointer jumping finds.

Null and empty texts have no words. A null id is the empty text in the hash of planted edits. Rows that repeat
count as often as they occur. An empty table gives no rows; extra columns are not read. Very long runs are words like
others: a tile's size is bounded in cells, not in rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintide.llm.shared import ship_package, stored

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
DELETE_EVERY = 31
SEGMENTS = 3
TILE = 256
CELLS = 1 << 22
HELD = 1 << 18

#: Latin-1 bytes: letters stay, A-Z lower-cased; everything else, and "?" for wider code points, is a space.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


def edited(run: bytes, mark: int, every: int) -> bytes:
    """The run (Latin-1) without one code point where the hash of id and run asks for it; ``mark`` is the id's part."""
    if not every:
        return run
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), mark)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counter(least_length: int, every: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def taken() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            batch = pa.record_batch([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for id, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                mark = zlib.crc32(f"{id.as_py() if id.is_valid else ''}:".encode())
                runs = text.as_py().encode("latin-1", "replace").translate(LETTERS).split()
                for run, times in Counter(r for r in runs if len(r) >= least_length).items():
                    word = edited(run, mark, every)
                    if len(word) >= least_length:
                        total[word] = total.get(word, 0) + times
                if len(total) > HELD:
                    yield taken()
        yield taken()

    return rows


def vocabulary(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    delete_every: int = 0,
) -> DataFrame:
    """(word, n): words of ``least_length`` code points with ``least_count`` occurrences at least.

    With ``delete_every``, a run whose crc32 of ``<id>:<run>`` that number divides loses its code point
    ``crc32 % length``.
    """
    ship_package(documents.sparkSession)
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    partial = rows.mapInArrow(counter(least_length, delete_every), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def block_key(low: Column, high: Column) -> Column:
    """Hash of what stands before and after the segment; equal hashes of different frames cost only comparisons."""
    after = F.col("size") - high
    tail = F.expr("substring(word, 1 + length(word))")
    tail = F.when(after > 0, F.substring("word", F.length("word") - after + 1, after)).otherwise(tail)
    return F.xxhash64("size", low, high, F.substring("word", F.lit(1), low), tail)


def blocked(words: DataFrame, least_length: int, segments: int = SEGMENTS) -> DataFrame:
    """(key, size, low, high, word, n): the blocks of every word as the shorter and as the longer of a pair."""
    sizes = F.filter(F.array(F.length("word"), F.length("word") - 1), lambda s: s >= least_length)
    cuts = F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment")
    rows = words.select("word", "n", F.explode(sizes).alias("size")).select("word", "n", "size", cuts)
    low, high = F.expr(f"size * segment div {segments}").cast("int"), F.expr(f"size * (segment + 1) div {segments}").cast("int")
    rows = rows.withColumns({"low": low, "high": high}).filter("low < high")
    return rows.select(block_key(F.col("low"), F.col("high")).alias("key"), "size", "low", "high", "word", "n")


def halved(rows: DataFrame) -> DataFrame:
    """The same members in blocks of half the segment."""
    middle = F.expr("(low + high) div 2").cast("int")
    halves = F.explode(F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high"))))
    rows = rows.select("size", "word", "n", halves.alias("half")).select("size", "half.low", "half.high", "word", "n")
    return rows.select(block_key(F.col("low"), F.col("high")).alias("key"), "size", "low", "high", "word", "n")


def common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of equal leading columns of broadcast rows that differ somewhere."""
    return (left != right).argmax(-1)


def near_pairs(
    ahead: np.ndarray, back: np.ndarray, lengths: np.ndarray, other: tuple[np.ndarray, np.ndarray, np.ndarray],
    size: np.ndarray, low: np.ndarray, high: np.ndarray,
) -> np.ndarray:
    """Which rows of two tiles are one edit apart and belong to this block: (tiles, rows, rows of the other).

    ``ahead`` holds code points from the front and ``back`` from the end, padded with 0; ``lengths`` is 0 for padding.
    """
    ahead_b, back_b, lengths_b = other
    prefix = common(ahead[:, :, None, :], ahead_b[:, None, :, :])
    suffix = common(back[:, :, None, :], back_b[:, None, :, :])
    longer = np.maximum(lengths[:, :, None], lengths_b[:, None, :])
    shorter = np.minimum(lengths[:, :, None], lengths_b[:, None, :])
    size, low, high = size[:, None, None], low[:, None, None], high[:, None, None]
    one_edit = (prefix + suffix >= longer - 1) & (shorter == size)
    return one_edit & (prefix >= low) & (suffix >= size - high) & ((low == 0) | (suffix < size - low))


class Members:
    """Blocks of one width as matrices: rows from the front and from the end, and where blocks begin."""

    def __init__(self, words: list[str], width: int) -> None:
        raw = [w.encode("latin-1") for w in words]
        self.ahead = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), np.uint8).reshape(-1, width)
        self.back = np.frombuffer(b"".join(r[::-1].ljust(width, b"\0") for r in raw), np.uint8).reshape(-1, width)
        self.lengths = np.array([len(r) for r in raw], np.int64)


def compared(words: list[str], size: int, begin: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j), i < j, of all near pairs of the blocks of one ``size`` in ``words``; block k is ``begin[k]:begin[k + 1]``."""
    width = size + 1
    rows = Members(words, width)
    counts = np.diff(begin)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def tile(blocks: np.ndarray, at: int, of: int, span: int) -> None:
        """Rows at..at+span of the blocks against their rows of..of+span."""
        places = [begin[blocks][:, None] + start + np.arange(span) for start in (at, of)]
        real = [p < begin[blocks + 1][:, None] for p in places]
        places = [np.where(r, p, 0) for p, r in zip(places, real, strict=True)]
        tiles = [(rows.ahead[p], rows.back[p], np.where(r, rows.lengths[p], 0)) for p, r in zip(places, real, strict=True)]
        hit = near_pairs(*tiles[0], tiles[1], np.full(len(blocks), size), low[blocks], high[blocks])
        k, i, j = np.nonzero(hit)
        left, right = places[0][k, i], places[1][k, j]
        once = left < right
        found.append((left[once], right[once]))

    side = max(1, min(TILE, int((CELLS / width) ** 0.5)))
    floor = 1
    while floor < counts.max(initial=0):
        span = min(2 * floor, side)
        these = np.flatnonzero((counts > floor) & (counts <= 2 * floor))
        step = max(1, CELLS // (span * span * width))
        for first in range(0, len(these), step):
            some = these[first : first + step]
            for at in range(0, 2 * floor, span):
                for of in range(at, 2 * floor, span):
                    tile(some, at, of, span)
        floor *= 2
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


EDGES = pa.schema([("open", pa.bool_()), ("size", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])
EDGE_ROW = "open boolean, size int, low int, high int, word string, n long, near string, near_n long"


def edges_of(batch: dict[str, list], begin: list[int]) -> pa.RecordBatch:
    """Both directions of the near pairs of whole blocks, which may differ in size."""
    words, n = np.array(batch["word"], object), np.array(batch["n"], np.int64)
    starts = np.array(begin, np.int64)
    sizes = np.array(batch["size"])[starts[:-1]]
    left, right = [], []
    for size in np.unique(sizes):
        which = np.flatnonzero(sizes == size)
        counts = np.diff(starts)[which]
        own = np.concatenate([[0], np.cumsum(counts)])
        rows = np.repeat(starts[which] - own[:-1], counts) + np.arange(own[-1])
        firsts = starts[which]
        i, j = compared(words[rows].tolist(), int(size), own, np.array(batch["low"])[firsts], np.array(batch["high"])[firsts])
        left.append(rows[i])
        right.append(rows[j])
    a = np.concatenate([*left, *right]).astype(np.int64)
    b = np.concatenate([*right, *left]).astype(np.int64)
    none = pa.nulls(len(a), pa.int32())
    return pa.record_batch(
        [pa.array(np.zeros(len(a), bool)), none, none, none, pa.array(words[a], pa.string()), pa.array(n[a]), pa.array(words[b], pa.string()), pa.array(n[b])],
        schema=EDGES,
    )


def tiler(tile: int):
    """Rows sorted by block in, near pairs and members of blocks above ``tile`` words out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["size", "low", "high", "word", "n"]
        ready: dict[str, list] = {c: [] for c in names}
        begin, cells = [0], 0
        block: dict[str, list] = {c: [] for c in names}
        key, wide = None, False

        def passed() -> pa.RecordBatch:
            size = len(block["word"])
            parts = [pa.array(np.ones(size, bool)), *(pa.array(block[c], EDGES.field(c).type) for c in names), pa.nulls(size, pa.string()), pa.nulls(size, pa.int64())]
            return pa.record_batch(parts, schema=EDGES)

        def closed() -> None:
            nonlocal cells
            if len(block["word"]) > 1:
                for c in names:
                    ready[c] += block[c]
                begin.append(len(ready["word"]))
                cells += len(block["word"]) * block["size"][0]

        for batch in batches:
            columns = batch.to_pydict()
            for i, k in enumerate(columns["key"]):
                if k != key:
                    if wide:
                        yield passed()
                    else:
                        closed()
                    key, wide = k, False
                    for c in names:
                        block[c].clear()
                    if cells > CELLS // 4:
                        yield edges_of(ready, begin)
                        cells, begin[1:] = 0, []
                        for c in names:
                            ready[c].clear()
                for c in names:
                    block[c].append(columns[c][i])
                if len(block["word"]) > tile and block["high"][0] - block["low"][0] > 1:
                    wide = True
                    if len(block["word"]) > 16 * tile:
                        yield passed()
                        for c in names:
                            block[c].clear()
        if wide:
            yield passed()
        else:
            closed()
        if len(begin) > 1:
            yield edges_of(ready, begin)

    return rows


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, tile: int = TILE) -> DataFrame:
    """(word, n, near, near_n) for both directions of every pair of ``words`` (word, n) one edit apart."""
    ship_package(words.sparkSession)
    rows, edges = blocked(words, least_length), None
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key")
        found = stored(dealt.mapInArrow(tiler(tile), EDGE_ROW), "tiles")
        pairs = found.filter("not open").select("word", "n", "near", "near_n")
        edges = pairs if edges is None else edges.unionByName(pairs)
        wide = found.filter("open").select("size", "low", "high", "word", "n")
        if wide.isEmpty():
            return edges
        rows = halved(wide)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms (word, form), which has no cycle."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = now.join(above, "root", "left")
        jumped = stored(jumped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, least_length: int = LEAST_LENGTH, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """One row per word of ``words`` (word, n): word, n, form, root, n_near, form_n."""
    words = stored(words.select("word", "n"), "vocabulary")
    near = near_words(words, least_length, tile)
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    found = near.groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), best)
    enough = -F.col("best.order") >= ratio * F.col("n")
    found = stored(found.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.order")).alias("form_n")), "near")
    ends = roots(found.filter("form is not null"))
    return words.join(found, "word", "left").join(ends, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
