"""Line dedup with two Bloom filters, once-seen and twice-seen.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased. Keys of ``shortest``
code points or more found in ``fewest`` documents or more lose all their lines, except in the largest id.

1. Every task fills a once-seen filter with its keys' hashes, and a twice-seen one with those that were in the
   first already. Merging tasks, a bit set in two once-seen filters is set in the twice-seen one. So the result
   holds every key of two documents or more. Only segments with a bit set travel.
2. The twice-seen filter has a fixed size, at most 2**28 bits, and is broadcast. A key that passes it is a suspect;
   suspects shuffle by their text, and are counted exactly. Sums are made per (key, slice) first, so a line that
   a third of all documents hold is neither one task nor one group.
3. The keys confirmed go back to the documents that hold them, as hash and SHA-256: the hash finds lines, the digest
   decides.

Rows that share an id are one document to the count, and all keep the line if their id is the largest; each row is
returned. Null ids count as the smallest, and each text without an id as a document. Null and empty texts are one
empty line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.llm.blocks import CODE_POINT, LOWER, U64, WHITE, SpanHash, blocks, mixed
from plaintide.llm.bloom import SEGMENT, Bits, bits_for
from plaintide.llm.shared import ship_package, slice_of, spread_totals, stored

SHORTEST = 20
FEWEST = 3
LINE_BYTES = 64


class Lines:
    """Lines of a block: raw spans, and the spans and hashes of the keys of those that are long enough."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shortest: int) -> None:
        breaks = np.flatnonzero(data == 10)
        self.start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
        self.offsets = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
        self.end = np.append(self.start[1:] - 1, 0)
        self.end[self.offsets[1:] - 1] = offsets[1:]
        solid = np.append(np.flatnonzero(~WHITE[data]), len(data))
        first = np.searchsorted(solid, self.start)
        last = np.searchsorted(solid, self.end) - 1
        points = np.concatenate([[0], np.cumsum(CODE_POINT[data])])
        begin, stop = solid[first], solid[np.maximum(last, 0)] + 1
        some = last >= first
        long = np.zeros(len(some), bool)
        long[some] = points[stop[some]] - points[begin[some]] >= shortest
        self.row = np.flatnonzero(long)
        self.begin, self.stop = begin[self.row], stop[self.row]
        self.lower = LOWER[data]
        self.hash = SpanHash.of_bytes(self.lower).spans(self.begin, self.stop)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.offsets))[self.row]

    def once_per_document(self) -> np.ndarray:
        """Indices of one line for each key and document."""
        return np.unique(mixed(self.hash ^ mixed(self.doc.astype(U64))), return_index=True)[1]


def filler(bits: int, shortest: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bits(bits), Bits(bits)
        for batch in batches:
            for _, data, offsets in blocks(batch, "text"):
                lines = Lines(data, offsets, shortest)
                keys, counts = np.unique(lines.hash[lines.once_per_document()], return_counts=True)
                twice.add(keys[(counts > 1) | once.has(keys)])
                once.add(keys)
        second = dict(twice.segments())
        for number, part in once.segments():
            yield pa.record_batch([pa.array([number]), pa.array([part]), pa.array([second.get(number)], pa.binary())], names=["segment", "once", "twice"])

    return rows


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the twice-seen filter; a task holds the segments it owns, however many parts arrive."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, first, second in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            new = np.frombuffer(first, np.uint8)
            have = twice.setdefault(number, np.zeros(SEGMENT, np.uint8)[: len(new)].copy())
            if second is not None:
                have |= np.frombuffer(second, np.uint8)
            if number in once:
                have |= once[number] & new
                once[number] |= new
            else:
                once[number] = new.copy()
    for number, have in twice.items():
        yield pa.record_batch([pa.array([number]), pa.array([have.tobytes()])], names=["segment", "part"])


def twice_seen(texts: DataFrame, shortest: int) -> tuple[int, bytes]:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bits_for(size // LINE_BYTES)
    parts = texts.mapInArrow(filler(bits, shortest), "segment long, once binary, twice binary")
    data = bytearray(1 << (bits - 3))
    for row in parts.repartition("segment").mapInArrow(merged, "segment long, part binary").toLocalIterator():
        data[row.segment * SEGMENT : row.segment * SEGMENT + len(row.part)] = row.part
    return bits, bytes(data)


def suspects(held, shortest: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = Bits(*held.value)
        for batch in batches:
            for rows_, data, offsets in blocks(batch, "text"):
                lines = Lines(data, offsets, shortest)
                some = np.flatnonzero(twice.has(lines.hash)) if len(lines.hash) else lines.row
                lower = lines.lower.tobytes()
                first: dict[tuple[int, bytes], int] = {}
                for i, own, a, b in zip(some.tolist(), lines.doc[some].tolist(), lines.begin[some].tolist(), lines.stop[some].tolist(), strict=True):
                    first.setdefault((own, lower[a:b]), i)
                one = np.fromiter(first.values(), np.int64, len(first))
                keys = [key for _, key in first]
                at = pa.array(lines.doc[one])
                yield pa.record_batch(
                    [batch.column(0)[rows_].take(at), batch.column(1)[rows_].take(at), pa.array(lines.hash[one].view(np.int64)), pa.array(keys, pa.binary())],
                    names=["id", "mark", "hash", "key"],
                )

    return rows


def dropper(shortest: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows_, data, offsets in blocks(batch, "text"):
                own = batch.slice(rows_.start, rows_.stop - rows_.start)
                drops = own.column(own.schema.get_field_index("drops"))
                raw = data.tobytes()
                texts = [raw[a:b] for a, b in pairwise(offsets.tolist())]
                counts, dropped = [text.count(b"\n") + 1 for text in texts], [0] * len(texts)
                some = np.flatnonzero(drops.is_valid().to_numpy(zero_copy_only=False))
                if len(some):
                    lines = Lines(data, offsets, shortest)
                    lower, flat = lines.lower.tobytes(), drops.flatten()
                    keys = dict(zip(some.tolist(), map(set, drops_of(drops.take(pa.array(some)))), strict=True))
                    near = np.flatnonzero(np.isin(lines.hash.view(np.int64), flat.field("hash").to_numpy()))
                    stay = np.ones(len(lines.start), bool)
                    for k, i, a, b in zip(near.tolist(), lines.doc[near].tolist(), lines.begin[near].tolist(), lines.stop[near].tolist(), strict=True):
                        if i in keys and hashlib.sha256(lower[a:b]).digest() in keys[i]:
                            stay[lines.row[k]] = False
                            dropped[i] += 1
                    for i in np.flatnonzero(dropped).tolist():
                        left = np.flatnonzero(stay[lines.offsets[i] : lines.offsets[i + 1]]) + lines.offsets[i]
                        texts[i] = b"\n".join(raw[a:b] for a, b in zip(lines.start[left].tolist(), lines.end[left].tolist(), strict=True))
                yield pa.record_batch(
                    [own.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                    names=["id", "text", "n_lines", "n_dropped"],
                )

    return rows


def drops_of(drops: pa.Array) -> Iterator[list[bytes]]:
    """The digests of each row's drops."""
    digests, ends = drops.flatten().field("sha").to_pylist(), np.concatenate([[0], np.cumsum(drops.value_lengths().to_numpy())])
    return (digests[a:b] for a, b in pairwise(ends.tolist()))


def one_row_per_document(found: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, slice, id) once per key and document. Only rows of repeated ids are compared, so others combine map-side."""
    repeated = stored(rows.groupBy("document").count().filter("count > 1").select("document"), "repeated")
    once = found.join(repeated, "document", "left_anti").select("key", "slice", "id")
    more = found.join(repeated, "document", "left_semi").select("key", "slice", "id", "document").distinct()
    return once.unionByName(more.drop("document"))


def line_dedup(documents: DataFrame, id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """One row per document: id, text without the lines dropped, n_lines before, n_dropped."""
    spark = documents.sparkSession
    ship_package(spark)
    rows = documents.select(F.col(id).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"), F.col(text).alias("text"))
    held = spark.sparkContext.broadcast(twice_seen(rows.select("text"), shortest))
    found = rows.mapInArrow(suspects(held, shortest), "id long, mark long, hash long, key binary")
    # The bits of a null id's mark tell texts apart, and its flag tells them from ids.
    document = F.struct(F.col("id").isNull().alias("absent"), F.coalesce("id", "mark").alias("number")).alias("document")
    found = stored(found.withColumn("slice", slice_of(F.coalesce("id", "mark"))), "suspects")
    partial = one_row_per_document(found.withColumn("document", document), rows.select(document))
    partial = partial.groupBy("key", "slice").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    often = spread_totals(partial, ["key"], {"n": F.sum("n"), "last": F.max("last")}).filter(F.col("n") >= fewest)
    drops = found.join(often.select("key", "slice", "last"), ["key", "slice"]).filter(~F.col("id").eqNullSafe(F.col("last")))
    drops = drops.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set(F.struct("hash", F.unhex(F.sha2("key", 256)).alias("sha"))).alias("drops"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    with_drops = rows.join(drops.hint("shuffle_hash"), same, "left").select("id", "text", "drops")
    return with_drops.mapInArrow(dropper(shortest), "id long, text string, n_lines long, n_dropped long").withColumnRenamed("id", id)
