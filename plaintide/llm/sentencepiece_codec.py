"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The search reads characters one by one. It holds the starts that a piece may still reach back to, which lie
within the longest piece, and the back pointers since the last boundary that is settled. Whenever all surviving
paths go through one boundary, the ids before it are committed and forgotten; a start survives while the text
since then is the begin of a piece. So a text of any length needs a window only.

Chunks that a task met of late are looked up; long ones go through the search each time. Ids are those of the best
path under the model's scores (see unigram.py). Decoding joins pieces and bytes, makes spaces of SPACE and
drops the first one, so it gives the text back, but for U+2581 itself, which a model cannot tell from a space.

Null and empty texts have no ids and decode to the empty text. Rows do not depend on each other. An empty table gives
no rows; extra columns are not read by the encoder and pass through the decoder.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.llm.byte_bpe import Recent
from plaintide.llm.packing import text_groups
from plaintide.llm.shared import ship_package
from plaintide.llm.unigram import CHUNK, SCORE, SPACE, Unigram, escaped, unigram

#: Chunks kept in each of two generations.
KNOWN = 200_000
HELD = 256
INFINITY = float("inf")


class StreamingViterbi:
    """Ids of a stream of characters, given out as soon as they are settled."""

    def __init__(self, model: Unigram) -> None:
        self.model = model
        self.held = 0

    def encode(self, characters: Iterable[str]) -> Iterator[int]:
        """Positions count from the last settled boundary; ``text`` holds what follows it.

        A start comes with the node of the trie that the text since then leads to.
        """
        root, unknown = self.model.trie, self.model.unknown
        text, at, best, back, starts, check = "", 0, [0.0], [0], [], HELD
        for character in characters:
            text += character
            alive = []
            top, origin = -INFINITY, at
            starts.append((at, root))
            at += 1
            for start, node in starts:
                node = node.get(character)
                if node is not None:
                    score = node.get(SCORE)
                    if score is None:
                        alive.append((start, node))
                        continue
                    if best[start] + score > top:
                        top, origin = best[start] + score, start
                    if len(node) > 1:
                        alive.append((start, node))
            if best[-1] + unknown > top:
                top, origin = best[-1] + unknown, at - 1
            best.append(top)
            back.append(origin)
            starts = alive
            if not alive:
                self.held = max(self.held, at)
                yield from self.ids(text, back, at)
                text, at, best, back, check = "", 0, [top], [0], HELD
            elif at >= check:
                self.held = max(self.held, at)
                settled = self.meeting(back, [at, *(start for start, _ in alive)])
                yield from self.ids(text, back, settled)
                text, best, at = text[settled:], best[settled:], at - settled
                back = [max(0, b - settled) for b in back[settled:]]
                starts = [(start - settled, node) for start, node in alive]
                check = at + HELD
        self.held = max(self.held, at)
        yield from self.ids(text, back, at)

    @staticmethod
    def meeting(back: list[int], ends: list[int]) -> int:
        """The last boundary that the paths to all ends have in common."""
        paths = set(ends)
        while len(paths) > 1:
            last = max(paths)
            paths.remove(last)
            paths.add(back[last])
        return paths.pop()

    def ids(self, text: str, back: list[int], end: int) -> list[int]:
        """The ids of the best path from the settled boundary to ``end``."""
        found: list[int] = []
        while end:
            start = back[end]
            piece = text[start:end]
            own = self.model.ids.get(piece)
            found.extend(reversed(self.model.spelled(piece)) if own is None else [own])
            end = start
        return found[::-1]


class Codec:
    """Encoding and decoding with a memory of chunks."""

    def __init__(self, path: str) -> None:
        self.model = unigram(path)
        self.search = StreamingViterbi(self.model)
        self.recent = Recent(KNOWN)
        values = {b: i for i, b in enumerate(self.model.bytes)}
        self.texts = [bytes([values[i]]) if i in values else p.replace(SPACE, " ").encode() for i, p in enumerate(self.model.pieces)]

    def packed(self, characters: Iterable[str]) -> bytes:
        return np.array(list(self.search.encode(characters)), "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        found = [CHUNK.findall(escaped(t)) for t in texts]
        chunks = set().union(*found)
        recent = self.recent
        recent.young.update((c, self.packed(c)) for c in recent.fresh(chunks))
        get = recent.young.__getitem__
        ids = [b"".join(map(get, own)) for own in found]
        recent.trim(chunks)
        return ids

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 text of little-endian 32-bit ids."""
        joined = b"".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return joined[1:] if joined[:1] == b" " else joined


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoder(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for first, texts in text_groups(batch.column(1)):
                yield pa.record_batch(
                    [batch.column(0)[first : first + len(texts)], pa.array(own.encode(texts), pa.binary())], names=["id", "ids"]
                )

    return rows


def decoder(path: str, ids: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            coded = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [None if c is None else own.decode(c).decode("utf-8", "replace") for c in coded]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return rows


def encode(documents: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids): little-endian 32-bit ids of every document."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(encoder(model), "id long, ids binary").withColumnRenamed("id", id)


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the text of their ids (null for null ids); a column of that name is replaced."""
    ship_package(encoded.sparkSession)
    rows = encoded.drop("decoded")
    return rows.mapInArrow(decoder(model, ids), T.StructType([*rows.schema, T.StructField("decoded", T.StringType())]))
