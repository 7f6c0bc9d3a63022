"""Token counts by dynamic programming over a trie of pre-tokens.

Distinct pre-tokens (chunks of unigram.py) are inserted in a trie. A node is a prefix; it holds the best score of
segmenting that prefix and the number of tokens of it, from the nodes above it and the pieces that end there. A
prefix that several pre-tokens share is scored once, and the node of a whole pre-token holds its count.
A text's count is the sum over its pre-tokens.

Each task keeps one trie for the rows it reads and begins a new one beyond NODES nodes, so memory is bounded and
nothing is shuffled. Chunks longer than LONG characters are scored along one path that is not kept.

Null and empty texts have no tokens. Rows do not depend on each other; ids may repeat or be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.llm.packing import text_groups
from plaintide.llm.shared import ship_package
from plaintide.llm.unigram import CHUNK, Unigram, escaped, unigram

NODES = 1_000_000
LONG = 64


class Trie:
    """Prefixes with (score, tokens) of their best segmentation."""

    def __init__(self, model: Unigram) -> None:
        self.model = model
        self.nodes: dict[str, tuple[float, int]] = {"": (0.0, 0)}
        self.terminals: dict[str, int] = {}

    def node(self, prefix: str, above) -> tuple[float, int]:
        """Score a prefix from the nodes above it; ``above(i)`` is the node of its first i characters."""
        scores, suffixes, size = self.model.scores, self.model.suffixes, len(prefix)
        best, tokens = -float("inf"), 0
        for k in range(1, min(size, self.model.longest) + 1):
            piece = prefix[size - k :]
            score = scores.get(piece)
            if score is not None or k == 1:
                before, count = above(size - k)
                total = before + (self.model.unknown if score is None else score)
                if total >= best:
                    best, tokens = total, count + (len(piece.encode()) if score is None else 1)
            if piece not in suffixes:
                break
        return best, tokens

    def insert(self, word: str) -> None:
        nodes, known = self.nodes, len(word)
        while word[:known] not in nodes:
            known -= 1
        for size in range(known + 1, len(word) + 1):
            nodes[word[:size]] = self.node(word[:size], lambda i: nodes[word[:i]])
        self.terminals[word] = nodes[word][1]

    def once(self, word: str) -> int:
        """The tokens of a long chunk; its path holds as many nodes as a piece has characters."""
        path, span = [(0.0, 0)], self.model.longest
        for size in range(1, len(word) + 1):
            begin = max(0, size - span)
            path.append(self.node(word[begin:size], lambda i, p=path, n=size - begin: p[i - n]))
            del path[: max(0, len(path) - span)]
        return path[-1][1]

    def counts(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        if len(self.nodes) > NODES:
            self.nodes, self.terminals = {"": (0.0, 0)}, {}
        found = [CHUNK.findall(escaped(t)) for t in texts]
        long = {}
        for word in set().union(*found).difference(self.terminals):
            if len(word) <= LONG:
                self.insert(word)
            else:
                long[word] = self.once(word)
        get = ({**self.terminals, **long} if long else self.terminals).__getitem__
        return [(len(words), sum(map(get, words))) for words in found]


def counter(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(unigram(path))
        for batch in batches:
            for first, texts in text_groups(batch.column(1)):
                counts = trie.counts(texts)
                yield pa.record_batch(
                    [
                        batch.column(0)[first : first + len(texts)],
                        pa.array([c[0] for c in counts], pa.int64()),
                        pa.array([c[1] for c in counts], pa.int64()),
                    ],
                    names=["id", "n_pretokens", "n_tokens"],
                )

    return rows


def token_counts(documents: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_pretokens, n_tokens."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(counter(model), "id long, n_pretokens long, n_tokens long").withColumnRenamed("id", id)
