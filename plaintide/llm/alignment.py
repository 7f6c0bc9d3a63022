"""Cross-tokenizer alignment by interval coalescing.

Both tokenizers of a text tile the same bytes: a space and the text. The tokens of A and B are lexsorted by their
start, the running maximum of their ends is accumulated, and a group ends where a start reaches that maximum: there
a token of A and one of B end together. Within groups the overlapping pairs are expanded; those whose byte ranges end
together are links.

Texts are cut before a space that stands between another character and a solid one. Neither tokenizer has a token
across such a place, so the ids of what lies between are looked up in a table of bounded size, and a long text goes
by in stretches.

Of a link, one token's bytes are a suffix of the other's. So the pairs that can be linked follow from the two
vocabularies alone; their number bounds the counts that are summed, sent to the driver and broadcast, whatever the
corpus. No text is shuffled, and a hot source or pair changes nothing.

Null and empty texts, and texts whose tokens do not give the text back (such as those with U+2581, which B takes for
a space), have no tokens: zero counts, empty groups and links. Rows are aligned each, repeated ones too, and count
as often as they occur. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.llm.byte_bpe import Recent, byte_of_character, piece_encoder, units_of
from plaintide.llm.shared import ship_package

#: Characters of text in one set of arrays; units kept in each of two generations.
STRETCH = 1 << 20
KNOWN = 200_000
SLOTS = 21
SPREAD = np.uint64(0x9E3779B97F4A7C15)

MARKED = "▁"


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the pairs that can end together."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        tokens = Tokenizer.from_file(a_path)
        self.encode_a = piece_encoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        plain = byte_of_character()
        self.a_bytes = [b""] * tokens.get_vocab_size()
        for token, number in tokens.get_vocab().items():
            self.a_bytes[number] = bytes(plain.get(c, 63) for c in token)
        self.b_bytes = [self.piece(i) for i in range(self.b.vocab_size())]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.codes = self.pairs()
        self.slots = np.full(1 << SLOTS, -1, np.int64)
        self.slots[self.slot(self.codes)] = np.arange(len(self.codes))
        self.recent = Recent(KNOWN)
        self.bad: set[str] = set()

    def piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(MARKED, " ").encode()

    def pairs(self) -> np.ndarray:
        """Sorted codes ``a * len(B) + b`` of the pairs of which one token's bytes are a suffix of the other's."""
        ids: list[dict[bytes, list[int]]] = [{}, {}]
        for side, tokens in zip(ids, (self.a_bytes, self.b_bytes), strict=True):
            for number, token in enumerate(tokens):
                if token:
                    side.setdefault(token, []).append(number)
        width, codes = len(self.b_bytes), set()
        for token, own in ids[0].items():
            for i in range(len(token)):
                codes.update(a * width + b for b in ids[1].get(token[i:], ()) for a in own)
        for token, own in ids[1].items():
            for i in range(1, len(token)):
                codes.update(a * width + b for a in ids[0].get(token[i:], ()) for b in own)
        return np.array(sorted(codes), np.int64)

    @staticmethod
    def slot(codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * SPREAD) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """The place of each code in ``codes``; a slot holds one of the codes that fall into it, the others are searched."""
        found = self.slots[self.slot(codes)]
        missed = np.flatnonzero(self.codes[found] != codes)
        found[missed] = np.searchsorted(self.codes, codes[missed])
        return found

    def learn(self, units: set[str]) -> None:
        """The ids of units that are not at hand; a unit stands behind a space."""
        fresh = self.recent.fresh(units)
        if not fresh:
            return
        behind = [f" {u}" for u in fresh]
        found_a = [self.encode_a(t) for t in behind]
        found_b = self.b.encode(fresh, num_threads=1)
        for unit, ids_a, ids_b in zip(fresh, found_a, found_b, strict=True):
            self.recent.young[unit] = array("I", ids_a).tobytes(), array("I", ids_b).tobytes()
        whole = "".join(behind).encode()
        for tokens, found in ((self.a_bytes, found_a), (self.b_bytes, found_b)):
            if b"".join(map(tokens.__getitem__, chain.from_iterable(found))) != whole:
                self.bad.update(u for u, ids, t in zip(fresh, found, behind, strict=True) if b"".join([tokens[i] for i in ids]) != t.encode())

    def forget(self, units: set[str]) -> None:
        """What is bad is not kept, and long units and those not used of late neither."""
        for unit in self.bad:
            self.recent.young.pop(unit, None)
        self.bad.clear()
        self.recent.trim(units)


@lru_cache(maxsize=1)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def decimals(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of each number below ``count``, left-aligned with a column to spare, and how many they are."""
    numbers = [str(i).encode() for i in range(count)]
    width = len(numbers[-1]) + 1
    return np.frombuffer(b"".join(n.ljust(width) for n in numbers), np.uint8).reshape(-1, width), np.array([len(n) for n in numbers])


class Coalesced:
    """Groups and links of texts that stand one behind another: tokens as (id, start, end) of A and of B."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, text_sizes: np.ndarray) -> None:
        self.a, self.b = a, b
        a_end, b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
        a_start, b_start = a_end - a_size[a], b_end - b_size[b]
        ends = np.concatenate([[0], np.cumsum(text_sizes)])
        self.a_cut, self.b_cut = np.searchsorted(a_end, ends, "right"), np.searchsorted(b_end, ends, "right")

        start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
        order = np.lexsort((np.repeat([0, 1], [len(a), len(b)]), start))
        reach = np.maximum.accumulate(end[order])
        fresh = np.ones(len(order), bool)
        fresh[1:] = start[order][1:] >= reach[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(fresh) - 1
        self.a_group, self.b_group = group[: len(a)], group[len(a) :]
        self.group_count = int(fresh.sum())
        self.groups_before = np.append(self.a_group, self.group_count)[self.a_cut]

        first = np.searchsorted(b_end, a_start, "right")
        count = np.searchsorted(b_start, a_end, "left") - first
        i = np.repeat(np.arange(len(a)), count)
        j = np.arange(len(i)) + np.repeat(first - (np.cumsum(count) - count), count)
        together = a_end[i] == b_end[j]
        self.link_a, self.link_b = i[together], j[together]
        self.link_cut = np.searchsorted(self.link_a, self.a_cut)

    def texts(self, table: tuple[np.ndarray, np.ndarray]) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` for each text."""
        digits, lengths = table
        inner = np.arange(self.group_count + 1)
        a_before, b_before = np.searchsorted(self.a_group, inner), np.searchsorted(self.b_group, inner)
        at_a = np.arange(len(self.a)) + b_before[self.a_group]
        at_b = np.arange(len(self.b)) + a_before[self.b_group + 1]
        ids, mark = np.empty(len(self.a) + len(self.b), np.int64), np.full(len(self.a) + len(self.b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = self.a, self.b
        mark[at_a[a_before[1:] - 1]] = ord("|")
        mark[at_b[b_before[1:] - 1]] = ord(";")
        size = lengths[ids]
        cells = digits[ids]
        cells[np.arange(len(ids)), size] = mark
        last = self.a_cut[1:] + self.b_cut[1:] - 1
        shown = size + 1
        shown[last] -= 1
        flat = cells[np.arange(digits.shape[1]) < shown[:, None]]
        offsets = np.concatenate([[0], np.cumsum(shown)])[np.append(0, last + 1)].astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(flat))


ALIGNED = pa.schema([
    ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups", pa.large_string()), ("links", pa.list_(pa.int32())),
])


def aligner(a_path: str, b_path: str, stretch: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabularies(a_path, b_path)
        table = decimals(max(len(own.a_bytes), len(own.b_bytes)))

        def coalesced(spans: list[list[str]], sizes: list[int]) -> tuple[list[np.ndarray], pa.Array, np.ndarray]:
            """Counts, group texts and links of spans of units; links go by ``link_cut``."""
            found = list(map(own.recent.young.__getitem__, chain.from_iterable(spans)))
            a = np.frombuffer(b"".join([f[0] for f in found]), np.uint32).astype(np.int64)
            b = np.frombuffer(b"".join([f[1] for f in found]), np.uint32).astype(np.int64)
            whole = Coalesced(a, b, own.a_size, own.b_size, np.array(sizes, np.int64))
            links = own.places(a[whole.link_a] * len(own.b_bytes) + b[whole.link_b]).astype(np.int32)
            return [np.diff(x) for x in (whole.a_cut, whole.b_cut, whole.groups_before, whole.link_cut)], whole.texts(table), links

        def many(ids: list, texts: list[str | None]) -> pa.RecordBatch:
            """Rows of texts that fit into one set of arrays."""
            spans = [units_of(t) if t and MARKED not in t else [] for t in texts]
            units = set().union(*spans)
            own.learn(units)
            if own.bad:
                spans = [s if own.bad.isdisjoint(s) else [] for s in spans]
            some = [i for i, s in enumerate(spans) if s]
            counts = np.zeros((4, len(texts)), np.int64)
            groups, links = pa.array([], pa.large_string()), np.empty(0, np.int32)
            if some:
                found, groups, links = coalesced([spans[i] for i in some], [1 + len(texts[i].encode()) for i in some])
                counts[:, some] = found
            place = np.full(len(texts), len(some))
            place[some] = np.arange(len(some))
            groups = pa.concat_arrays([groups, pa.array([""], pa.large_string())]).take(pa.array(place))
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts[3])]).astype(np.int32))
            own.forget(units)
            return pa.record_batch([pa.array(ids, pa.int64()), *map(pa.array, counts), groups, pa.ListArray.from_arrays(offsets, pa.array(links))], schema=ALIGNED)

        def long(id: int | None, text: str) -> pa.RecordBatch:
            """The row of one long text, a stretch of units after another."""
            units = units_of(text) if MARKED not in text else []
            totals, groups, links, first = np.zeros(4, np.int64), [], [], 0
            ends = np.cumsum([1 + len(u) for u in units])
            while first < len(units):
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + stretch, "right")))
                part = units[first:last]
                distinct = set(part)
                own.learn(distinct)
                if not own.bad.isdisjoint(distinct):
                    totals, groups, links = np.zeros(4, np.int64), [], []
                    own.forget(distinct)
                    break
                counts, texts, found = coalesced([part], [1 + len(" ".join(part).encode())])
                totals += np.array(counts)[:, 0]
                groups.append(texts[0].as_py())
                links.append(found)
                own.forget(distinct)
                first = last
            lists = pa.ListArray.from_arrays([0, int(totals[3])], pa.array(np.concatenate(links) if links else np.empty(0, np.int32)))
            return pa.record_batch([pa.array([id], pa.int64()), *(pa.array([t]) for t in totals), pa.array([";".join(groups)], pa.large_string()), lists], schema=ALIGNED)

        for batch in batches:
            ids, texts, held = [], [], 0
            for id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if text is not None and len(text) > stretch:
                    yield long(id, text)
                    continue
                ids.append(id)
                texts.append(text)
                held += len(text or "")
                if held >= stretch:
                    yield many(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield many(ids, texts)
        own.recent.clear()

    return rows


def align(documents: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", stretch: int = STRETCH) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2``), links.

    ``links`` has an entry per linked occurrence, the place of its pair in :func:`pair_table`.
    """
    ship_package(documents.sparkSession)
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<int>"
    return rows.mapInArrow(aligner(a_path, b_path, stretch), schema).withColumnRenamed("id", id)


def pair_table(a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray]:
    """(A id, B id) of every pair that two vocabularies can link, by its place."""
    own = vocabularies(a_path, b_path)
    return np.divmod(own.codes, len(own.b_bytes))


def pair_totals(aligned: DataFrame, pairs: int) -> np.ndarray:
    """Links of each pair in all rows of :func:`align`; tasks sum into one array of ``pairs`` numbers."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pairs, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=pairs)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(pairs, np.int64)
        total[frame.pair] = frame.n
        return pd.DataFrame({"total": [total.tobytes()]})

    totals = aligned.select("links").mapInArrow(summed, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = totals.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(packed, "total binary").collect()
    return np.frombuffer(found[0].total, np.int64) if found else np.zeros(pairs, np.int64)


def linked_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The rows of :func:`align`, which should be stored, with n_best and count_sum in place of their links."""
    _, b = pair_table(a_path, b_path)
    totals = pair_totals(aligned, len(b))
    most = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, b, totals)
    held = aligned.sparkSession.sparkContext.broadcast((totals, totals == most[b]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = held.value
        for batch in batches:
            links = batch.column(1)
            offsets = links.offsets.to_numpy() - links.offsets[0].as_py()
            at = links.flatten().to_numpy()
            sums = [np.diff(np.concatenate([[0], np.cumsum(values[at])])[offsets]) for values in (best, count)]
            yield pa.record_batch([batch.column(0), *(pa.array(s.astype(np.int64)) for s in sums)], names=["row", "n_best", "count_sum"])

    others = [c for c in aligned.columns if c != "links"]
    rows = aligned.select(F.struct(*others).alias("row"), "links")
    kept = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(scored, f"row {kept}, n_best long, count_sum long").select("row.*", "n_best", "count_sum")
