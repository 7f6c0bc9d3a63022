"""Suffix-array dedup: repeated byte strings of ``width`` bytes, found by most-significant-digit passes.

A suffix is ordered through its first ``width`` bytes only, and equal groups are the repeated windows. The bytes
of a window are looked at in three digits, and suffixes that are alone in their group leave after each pass:

1. The first digit is the window's anchor: of its GRAM-byte strings, the one with the least hash (the leftmost
   of equal ones). Equal windows have equal anchors at equal places, so all windows with one anchor, a run of
   neighbouring starts, are one row: about one row for 70 bytes of text. Anchors met once leave.
2. The second digit is the whole run, from its first window's start to its last window's end. Runs that are
   equal as a whole are repeated in every window.
3. Where an anchor occurs with different runs, the windows themselves are compared, by their 64-bit hashes. The
   bytes around such anchors travel with them; a group of one anchor is one sorted stream within a task.

Anchors with more than HOT rows are dealt over SLICES groups. What such a group can't settle by itself, and one
of each kind that it can, goes on as (hash, place) rows to a last pass over all slices, with partial sums.

Which anchors occur twice, occur with different runs, or are hot is kept in three Bloom filters of bounded
size. They only decide what travels: an anchor that passes by chance is found to be alone by the passes.
Hashes of 64 bits stand for strings; two different runs or windows would have to agree in their anchor's hash
and in their own.

Text is UTF-8 bytes, null is empty, and a window never crosses documents. All occurrences of a repeated string
are removed, judged on the input. Rows with one id and one text are one document to the result, and their
bytes are repeated; a null id is a value like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.llm.blocks import U64, SpanHash, blocks, columns, mixed
from plaintide.llm.bloom import Bits, bits_for, union_of
from plaintide.llm.shared import SLICES, ship_package, slice_of, stored

WIDTH = 200
GRAM = 64
HOT = 4096

Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each window of ``width`` keys: the least of a block's tail and the next one's head."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(U64).max, U64)
    padded[: len(keys)] = keys
    table = padded.reshape(-1, width)
    heads = np.minimum.accumulate(table, axis=1).ravel()
    tails = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tails[:count], heads[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> Block:
    """(document, anchor place, first start, last start, anchor hash, run hash) of each run of a block.

    Places count from the block's begin. The run hash covers the run's bytes and the anchor's place in them.
    """
    none = np.empty(0, np.int64)
    starts = np.arange(max(0, len(data) - width + 1))
    owner = np.searchsorted(offsets, starts, "right") - 1
    starts = starts[starts + width <= offsets[owner + 1]] if len(starts) else starts
    if not len(starts):
        return none, none, none, none, none.view(U64), none.view(U64)
    spans = SpanHash.of_bytes(data)
    grams = spans.rolling(gram)
    bits = U64(max(20, int(len(grams)).bit_length()))
    keys = (grams >> bits << bits) | np.arange(len(grams), dtype=U64)
    least = window_minima(keys, width - gram + 1)[starts]
    place = (least & ((U64(1) << bits) - U64(1))).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    place, lo, hi = place[first], starts[first], starts[last]
    whole = spans.spans(lo, hi + width) + mixed(((place - lo) * (1 << 20) + (hi - lo)).astype(U64))
    return np.searchsorted(offsets, place, "right") - 1, place, lo, hi, grams[place], mixed(whole)


def grouped(gram: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows, and least and greatest run, of each anchor hash."""
    order = np.argsort(gram, kind="stable")
    gram, run = gram[order], run[order]
    first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.empty(0, int)
    if not len(first):
        return gram, first, run, run
    return gram[first], np.diff(np.append(first, len(gram))), np.minimum.reduceat(run, first), np.maximum.reduceat(run, first)


def first_digit(width: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(data, offsets, width, gram)[4:] for _, data, offsets in blocks(batch, "text")]
            if found:
                key, n, low, high = grouped(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]).view(np.int64))
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(n, pa.int64()), pa.array(low), pa.array(high)], names=["gram", "n", "low", "high"])

    return rows


ANCHOR = "gram long, slice int, run long, id long, mark long, lo long, hi long, around binary"


def binary(data: np.ndarray, start: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> pa.Array:
    """The bytes of spans as a binary column, null where not wanted."""
    text = data.tobytes()
    return pa.array([text[a:b] if w else None for a, b, w in zip(start.tolist(), end.tolist(), wanted.tolist(), strict=True)], pa.binary())


def later_digits(width: int, gram: int, filters):
    """Rows of the anchors that may repeat, with the bytes of their run where an anchor has several runs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, several, hot = (Bits(bits, data) for bits, data in filters.value)
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1).to_numpy()
            for rows_, data, offsets in blocks(batch, "text"):
                doc, _, lo, hi, key, run = anchors(data, offsets, width, gram)
                keep = np.flatnonzero(repeated.has(key)) if len(key) else np.empty(0, int)
                doc, lo, hi, key, run = doc[keep], lo[keep], hi[keep], key[keep], run[keep]
                mark = marks[rows_][doc]
                dealt = np.where(hot.has(key), mixed(mark.view(U64) ^ mixed(lo.view(U64))) % U64(SLICES), 0) if len(key) else keep
                begin = offsets[doc]
                yield pa.record_batch(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(dealt, pa.int32()),
                        pa.array(run.view(np.int64)),
                        ids[rows_].take(pa.array(doc)),
                        pa.array(mark),
                        pa.array(lo - begin),
                        pa.array(hi - begin),
                        binary(data, lo, hi + width, several.has(key) if len(key) else keep),
                    ],
                    names=["gram", "slice", "run", "id", "mark", "lo", "hi", "around"],
                )

    return rows


FOUND = "key long, hot boolean, id long, mark long, lo long, hi long"


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted stream again, cut where (gram, slice) changes; a batch's last group waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        part = batch.column(1).to_numpy()
        last = np.flatnonzero((key != key[-1]) | (part != part[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if held:
            before = held[-1]
            same = before.column(0)[-1].as_py() == key[0] and before.column(1)[-1].as_py() == part[0]
            if not same:
                yield pa.Table.from_batches(held)
                held = []
            elif cut == 0:
                held.append(batch)
                continue
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def resolver(width: int, hot_filter):
    """Repeated places of each group, and the open rows of hot ones.

    A result without ``hot`` is a repeated place. With it, the row is a key that other slices may have too; a
    row with a null ``lo`` stands for places already found, so that its partners elsewhere are found as well.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = Bits(*hot_filter.value)
        for table in groups_of(batches):
            gram = table.column("gram").to_numpy().view(U64)
            group = mixed(gram ^ mixed(table.column("slice").to_numpy().astype(U64)))
            run = table.column("run").to_numpy().view(U64)
            ids, mark = table.column("id").combine_chunks(), table.column("mark").to_numpy()
            lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
            around = table.column("around").combine_chunks()
            elsewhere = hot.has(gram)
            bare = np.asarray(around.is_null())
            out: list[tuple] = []

            def emit(where: np.ndarray, key: np.ndarray, is_hot: bool, first: np.ndarray | None, last: np.ndarray | None) -> None:
                if len(where):
                    blank = pa.nulls(len(where), pa.int64())
                    out.append((
                        pa.array(key.view(np.int64)), pa.array(np.full(len(where), is_hot)),
                        blank if first is None else ids.take(pa.array(where)), blank if first is None else pa.array(mark[where]),
                        blank if first is None else pa.array(first), blank if first is None else pa.array(last),
                    ))

            whole = mixed(gram ^ mixed(run))
            local = mixed(whole ^ group)
            order = np.argsort(local, kind="stable")
            fresh = np.append(True, local[order][1:] != local[order][:-1])
            number = np.cumsum(fresh) - 1
            count = np.bincount(number)
            twice = np.empty(len(gram), bool)
            twice[order] = count[number] > 1
            leader = np.zeros(len(gram), bool)
            leader[order[fresh]] = True
            settled = np.flatnonzero(twice)
            emit(settled, whole[settled], False, lo[settled], hi[settled] + width)
            at = np.flatnonzero(elsewhere & bare & twice & leader)
            emit(at, whole[at], True, None, None)
            at = np.flatnonzero(elsewhere & bare & ~twice)
            emit(at, whole[at], True, lo[at], hi[at] + width)

            one = np.flatnonzero(leader & ~bare)
            if len(one):
                _, ends, data = around.take(pa.array(one)).buffers()
                ends, data = np.frombuffer(ends, np.int32)[: len(one) + 1].astype(np.int64), np.frombuffer(data, np.uint8)
                sizes = np.diff(ends) - width + 1
                row = np.repeat(np.arange(len(one)), sizes)
                within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                start = ends[row] + within
                window = SpanHash.of_bytes(data).spans(start, start + width)
                window = mixed(window ^ mixed(gram[one][row]))
                inside = mixed(window ^ group[one][row])
                order = np.argsort(inside, kind="stable")
                fresh = np.append(True, inside[order][1:] != inside[order][:-1])
                number = np.cumsum(fresh) - 1
                paired = np.empty(len(row), bool)
                paired[order] = np.bincount(number)[number] > 1
                alone = ~twice[one][row]
                here = np.flatnonzero(paired & alone)
                places = lo[one][row] + within
                emit(one[row[here]], window[here], False, places[here], places[here] + width)
                far = elsewhere[one][row]
                head = np.zeros(len(row), bool)
                head[order[fresh]] = True
                at = np.flatnonzero(far & head & (paired | ~alone))
                emit(one[row[at]], window[at], True, None, None)
                at = np.flatnonzero(far & ~paired & alone)
                emit(one[row[at]], window[at], True, places[at], places[at] + width)
            for columns_ in out:
                yield pa.record_batch(list(columns_), names=["key", "hot", "id", "mark", "lo", "hi"])

    return rows


def repeated_places(documents: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(id, mark, lo, hi): byte ranges covered by repeated windows, possibly overlapping.

    ``documents`` has (id, mark, text), mark being a hash of the text.
    """
    spark = documents.sparkSession
    digits = documents.select("text").mapInArrow(first_digit(width, gram), "gram long, n long, low long, high long")
    totals = digits.groupBy("gram").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    totals = stored(totals.filter("n > 1").select("gram", (F.col("low") != F.col("high")).alias("several"), (F.col("n") > HOT).alias("hot")), "anchors")
    filters = []
    for kept in (totals, totals.filter("several"), totals.filter("hot")):
        bits = bits_for(kept.count())
        filters.append((bits, union_of(kept.select("gram"), bits)))
    held, hot = spark.sparkContext.broadcast(filters), spark.sparkContext.broadcast(filters[2])
    rows = documents.mapInArrow(later_digits(width, gram, held), ANCHOR)
    rows = rows.repartition("gram", "slice").sortWithinPartitions("gram", "slice")
    found = stored(rows.mapInArrow(resolver(width, hot), FOUND), "places")
    open_ = found.filter("hot")
    partial = open_.withColumn("slice", slice_of("id", "mark", "lo")).groupBy("key", "slice").agg(
        F.count("*").alias("n"), F.max(F.col("lo").isNull()).alias("known"))
    keys = partial.groupBy("key").agg(F.sum("n").alias("n"), F.max("known").alias("known")).filter("known or n > 1").select("key")
    wanted = partial.select("key", "slice").join(keys, "key")
    late = open_.filter("lo is not null").withColumn("slice", slice_of("id", "mark", "lo")).join(wanted, ["key", "slice"], "left_semi")
    return found.filter("not hot").select("id", "mark", "lo", "hi").unionByName(late.select("id", "mark", "lo", "hi"))


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return lo[first], hi[np.append(first[1:], len(lo)) - 1]


def with_places(documents: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The rows of (id, mark, text, …) with ``places``: their repeated ranges, null if there are none."""
    found = repeated_places(documents.select("id", "mark", "text"), width, gram)
    each = found.groupBy("id", "mark").agg(F.collect_list(F.struct("lo", "hi")).alias("places"))
    each = each.withColumnsRenamed({"id": "_id", "mark": "_mark"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return documents.join(each.hint("shuffle_hash"), same, "left").drop("_id", "_mark")


def marked(documents: DataFrame, id: str, text: str) -> DataFrame:
    return documents.select(F.col(id).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"), F.col(text).alias("text"))


def cut(raw: bytes, places: pa.Scalar) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes outside the places, and the places as maximal runs."""
    if not places.is_valid:
        none = np.empty(0, np.int64)
        return raw, none, none
    lo, hi = merged(places.values.field(0).to_numpy(), places.values.field(1).to_numpy())
    begin, end = [0, *hi.tolist()], [*lo.tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(begin, end, strict=True)), lo, hi


def per_row(work: Callable[[bytes, pa.Scalar], tuple], names: list[str], types: list[pa.DataType], passed: list[str]):
    """A batch function: ``work`` for each text and its places, beside the columns passed on."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = columns(batch, "text")
            raw, places = data.tobytes(), batch.column(batch.schema.get_field_index("places"))
            made = [work(raw[ends[i] : ends[i + 1]], places[i]) for i in range(batch.num_rows)]
            values = [pa.array([m[j] for m in made], kind) for j, kind in enumerate(types)]
            yield pa.record_batch([*(batch.column(batch.schema.get_field_index(c)) for c in passed), *values], names=[*passed, *names])

    return rows


def digest(raw: bytes, places: pa.Scalar) -> tuple[int, int, int, str]:
    kept, lo, _ = cut(raw, places)
    return len(raw), len(raw) - len(kept), len(lo), hashlib.sha256(kept).hexdigest()


def suffix_dedup(documents: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    ship_package(documents.sparkSession)
    work = per_row(digest, ["n_bytes", "n_removed", "n_spans", "kept_sha256"], [pa.int64()] * 3 + [pa.string()], ["id"])
    done = with_places(marked(documents, id, text), width, gram).mapInArrow(work, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return done.withColumnRenamed("id", id)


def without_repeats(raw: bytes, places: pa.Scalar) -> tuple[str | None]:
    """The text left; a character that loses some of its bytes goes."""
    return (cut(raw, places)[0].decode("utf-8", "ignore") if places.is_valid else None,)


def removed_repeats(documents: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(id, mark, rest): the text without its repeated strings, for the documents that have any."""
    ship_package(documents.sparkSession)
    work = per_row(without_repeats, ["rest"], [pa.string()], ["id", "mark"])
    found = with_places(marked(documents, id, text), width, gram).filter("places is not null")
    return found.mapInArrow(work, "id long, mark long, rest string")
