"""Quality rules: a few counts of a text, and bands of its zstandard compression ratio.

The ratio (bytes by compressed bytes) of the whole text and of its chunks must lie between limits, which depend on
the length, as short texts compress less: repetitive text lies above them, random or encoded text below. A text is
rejected if its own ratio is outside, or if chunks outside hold more than a fifth of its bytes: that finds
repetitive and encoded parts of an ordinary text.

Chunks of CHUNK bytes see repetitions of a long period. Each is cut into parts of an eighth of the text at most (PART
bytes at least), which see junk that a chunk dilutes. The last chunk and part may be shorter. The bytes of a
chunk are outside if it is, or else those of its parts that are.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words, a ratio of zero, and fail the base rules.
One pass, no shuffle; a row does not depend on any other, so repeated rows and null ids are returned as they are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintide.llm.blocks import CODE_POINT, U64, WHITE, SpanHash, Words, blocks, mixed, runs
from plaintide.llm.shared import ship_package

LEVEL = 3
CHUNK = 4096
CHUNK_LIMITS = (1.45, 3.5)
PART = 256
BYTES_OUTSIDE = 0.2
#: (bytes from, least ratio, greatest ratio); below 128 bytes the frame itself weighs too much for a lower limit.
#: From 192 bytes on a least ratio lies above base64 at the band's end and below clean text at its start.
BANDS = [
    (0, 0.0, 3.0), (128, 1.0, 2.8), (192, 1.09, 2.8), (256, 1.16, 2.8), (384, 1.22, 2.8), (512, 1.3, 3.2),
    (1024, 1.38, 3.2), (2048, 1.42, 4.0), (4096, 1.45, 4.0), (16384, 1.45, 5.0),
]
LEAST_WORDS = 20
WINDOW = 8
REPEATED_PERCENT = 30

SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["n_bytes", "n_chunks", "n_chunks_outside", "n_bytes_outside"]


def per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def alike(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    fresh = np.append(True, keys[order][1:] != keys[order][:-1]) if len(keys) else np.empty(0, bool)
    number = np.cumsum(fresh) - 1
    twice = np.empty(len(keys), bool)
    twice[order] = np.bincount(number)[number] > 1 if len(keys) else fresh
    return twice


def duplicate_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document; lines of equal hashes are compared by bytes."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    lines_before = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(lines_before))
    end = np.empty(len(start), np.int64)
    end[:-1] = start[1:] - 1
    last = lines_before[1:] - 1
    end[last] = offsets[1:]
    solid = np.concatenate([[0], np.cumsum(~WHITE[data])])
    some = np.flatnonzero(solid[end] > solid[start])
    keys = SpanHash.of_bytes(data).spans(start[some], end[some])
    some = some[alike(mixed(keys ^ mixed(doc[some].astype(U64))))]
    raw, seen, counts = data.tobytes(), set(), np.zeros(len(offsets) - 1, np.int64)
    for own, a, b in zip(doc[some].tolist(), start[some].tolist(), end[some].tolist(), strict=True):
        line = own, raw[a:b]
        counts[own] += line in seen
        seen.add(line)
    return counts


def repeated_words(data: np.ndarray, found: Words) -> np.ndarray:
    """Words inside windows of WINDOW words that occur twice or more in their document.

    Of windows with equal hashes the words are compared.
    """
    sequence = SpanHash(SpanHash.of_bytes(data).spans(found.start, found.end))
    starts = runs(found.offsets, WINDOW)
    doc = found.documents()
    starts = starts[alike(mixed(sequence.spans(starts, starts + WINDOW) ^ mixed(doc[starts].astype(U64))))]
    raw = data.tobytes()
    windows = [(own, *raw[a:b].split()) for own, a, b in zip(doc[starts].tolist(), found.start[starts].tolist(), found.end[starts + WINDOW - 1].tolist(), strict=True)]
    times = Counter(windows)
    starts = starts[np.fromiter((times[w] > 1 for w in windows), bool, len(windows))]
    change = np.zeros(len(doc) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return per_document(np.cumsum(change[:-1]) > 0, found.offsets)


def limits(size: int) -> tuple[float, float]:
    """Least and greatest ratio of a chunk or part of so many bytes."""
    return CHUNK_LIMITS if size == CHUNK else next((low, high) for least, low, high in reversed(BANDS) if size >= least)


def part_size(size: int) -> int:
    """The greatest power of two up to an eighth of a text, from PART to CHUNK."""
    return min(max(1 << (size // 8).bit_length() >> 1, PART), CHUNK)


def ratios(raw: bytes, compress) -> tuple[float, int, int, int]:
    """Ratio of the whole text, its chunks, how many of them lie outside their limits, and the bytes outside."""
    if not raw:
        return 0.0, 0, 0, 0

    def outside(piece: bytes) -> bool:
        low, high = limits(len(piece))
        return not low <= len(piece) / len(compress(piece)) <= high

    step = part_size(len(raw))
    chunks = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]
    n_outside = bytes_outside = 0
    for chunk in chunks:
        if outside(chunk):
            n_outside += 1
            bytes_outside += len(chunk)
        elif step < len(chunk):
            parts = (chunk[i : i + step] for i in range(0, len(chunk), step))
            bytes_outside += sum(len(p) for p in parts if outside(p))
    return len(raw) / len(compress(raw)), len(chunks), n_outside, bytes_outside


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        for rows, data, offsets in blocks(batch, "text"):
            found = Words(data, offsets)
            points = CODE_POINT[data]
            raw = data.tobytes()
            ratio = [ratios(raw[a:b], compress) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            counts = [
                found.counts,
                per_document(points & ~WHITE[data], offsets),
                per_document(SYMBOL[data], offsets),
                duplicate_lines(data, offsets),
                repeated_words(data, found),
                np.diff(offsets),
                np.array([r[1] for r in ratio]),
                np.array([r[2] for r in ratio]),
                np.array([r[3] for r in ratio]),
            ]
            arrays = [batch.column(0)[rows], *(pa.array(c, pa.int64()) for c in counts), pa.array([r[0] for r in ratio], pa.float64())]
            yield pa.record_batch(arrays, names=["id", *COUNTS, *RATIOS, "ratio"])


def within_bands() -> Column:
    """Whether the whole text's ratio lies within the limits of its length."""
    verdict = None
    for least_bytes, low, high in BANDS:
        inside = F.col("ratio").between(low, high)
        verdict = F.when(F.col("n_bytes") >= least_bytes, inside).otherwise(verdict) if verdict is not None else inside
    return verdict


def quality_rules(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, the counts, ratio, n_chunks, n_chunks_outside, n_bytes_outside, base_failed, kept."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    counts = ", ".join(f"{c} long" for c in [*COUNTS, *RATIOS])
    found = rows.mapInArrow(measured, f"id long, {counts}, ratio double")
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    chunks_fine = F.col("n_bytes_outside") <= BYTES_OUTSIDE * F.col("n_bytes")
    return found.withColumns({"base_failed": base_failed, "kept": ~base_failed & within_bands() & chunks_fine}).withColumnRenamed("id", id)
