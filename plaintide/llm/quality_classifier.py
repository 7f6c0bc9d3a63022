"""Quality classifier: gated attention over the passages of a document, learnt from document labels.

Every passage of a text (PASSAGE words, the whole text is covered) is encoded: frequencies of byte classes, of
hashed words, and a few shares. A hidden layer makes a vector h of it; gated attention gives it the weight
softmax(w . (tanh(V h) * sigmoid(U h))) among the document's passages, and the score is the logistic of the
weighted mean. A document's label is all that training sees; which passages matter is learnt.

The model is fitted on a bounded sample: of the labelled rows that are not held out, SAMPLE with the least hash of
their id, in one task. Labels, language, source and id are no inputs. Scoring is one pass over all rows without
a shuffle.

Null and empty texts are one passage without words and get a score like any other. Without any labels, or
with one class only, the model is the share of label 1 (0.5 without labels). Rows with equal ids are scored each;
of several labels of one id the least counts, and labels that are null count as none. Extra columns of any name
pass through.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.llm.blocks import LOWER, U64, SpanHash, Words, blocks, mixed
from plaintide.llm.shared import ship_package

PASSAGE = 64
WORD_BUCKETS = 128
SAMPLE = 4000
HIDDEN, GATE = 24, 12
EPOCHS, STEPS, BATCH, RATE, DECAY = 30, 1500, 64, 0.01, 1e-3

#: Printable ASCII one by one, then line feed, other control bytes, first bytes and later bytes of wider characters.
CLASS = np.full(256, 98)
CLASS[32:127] = np.arange(95)
CLASS[:32], CLASS[127], CLASS[10] = 96, 96, 95
CLASS[0xC0:] = 97
CLASSES = 99
FEATURES = CLASSES + WORD_BUCKETS + 4


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage of a block, and the first passage of each document."""
    found = Words(data, offsets)
    per_doc = np.maximum(1, -(-found.counts // PASSAGE))
    begin = np.concatenate([[0], np.cumsum(per_doc)])
    total = int(begin[-1])
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    within = np.arange(total) - begin[doc]
    first_word = found.offsets[doc] + PASSAGE * within
    starts = offsets[doc].copy()
    later = within > 0
    starts[later] = found.start[first_word[later]]
    lengths = np.diff(np.append(starts, len(data)))
    of_byte = np.repeat(np.arange(total), lengths)
    kinds = np.bincount(of_byte * CLASSES + CLASS[data], minlength=total * CLASSES).reshape(total, CLASSES)

    word_doc = found.documents()
    of_word = begin[word_doc] + (np.arange(len(found.start)) - found.offsets[word_doc]) // PASSAGE
    words = SpanHash.of_bytes(LOWER[data]).spans(found.start, found.end)
    bags = np.bincount(of_word * WORD_BUCKETS + (words % U64(WORD_BUCKETS)).astype(np.int64), minlength=total * WORD_BUCKETS)
    bags = bags.reshape(total, WORD_BUCKETS)
    counts = np.bincount(of_word, minlength=total)
    _, first = np.unique(mixed(words ^ mixed(of_word.astype(U64))), return_index=True)
    distinct = np.bincount(of_word[first], minlength=total)
    letters = np.bincount(of_word, found.end - found.start, minlength=total)
    some = np.maximum(counts, 1)
    shares = np.stack([distinct / some, np.log1p(letters / some), counts / PASSAGE, np.log1p(lengths)], 1)
    size = np.maximum(lengths, 1)[:, None]
    return np.concatenate([np.sqrt(kinds / size), np.sqrt(bags / some[:, None]), shares], 1).astype(np.float32), begin


def softmax_of(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    sizes = np.diff(begin)
    e = np.exp(x - np.repeat(np.maximum.reduceat(x, begin[:-1]), sizes))
    return e / np.repeat(np.add.reduceat(e, begin[:-1]), sizes)


class Model:
    """Weights, scores and gradients of the attention model."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @classmethod
    def fresh(cls, mean: np.ndarray, scale: np.ndarray) -> Model:
        r = np.random.default_rng(10)
        shapes = {"W": (FEATURES, HIDDEN), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE)}
        drawn = {k: r.normal(0, s[0] ** -0.5, s) for k, s in shapes.items()}
        zero = {"b": np.zeros(HIDDEN), "a": r.normal(0, GATE**-0.5, GATE), "c": r.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1)}
        return cls(drawn | zero | {"mean": mean, "scale": scale})

    @classmethod
    def constant(cls, share: float) -> Model:
        model = cls.fresh(np.zeros(FEATURES), np.ones(FEATURES))
        model.w["c"][:] = 0
        share = min(max(share, 1e-6), 1 - 1e-6)
        model.w["d"][:] = np.log(share / (1 - share))
        return model

    def forward(self, x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
        w = self.w
        x = np.clip((x - w["mean"]) / w["scale"], -8, 8)
        h = np.tanh(x @ w["W"] + w["b"])
        v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        attention = softmax_of((v * u) @ w["a"], begin)
        z = np.add.reduceat(h * attention[:, None], begin[:-1])
        return x, h, v, u, attention, z, 1 / (1 + np.exp(-(z @ w["c"] + w["d"])))

    def gradients(self, x: np.ndarray, begin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w, sizes = self.w, np.diff(begin)
        x, h, v, u, attention, z, p = self.forward(x, begin)
        slope = (p - y) * weight / len(y)
        dz = np.repeat(slope[:, None] * w["c"], sizes, axis=0)
        pull = (dz * h).sum(1)
        dlogit = attention * (pull - np.repeat(np.add.reduceat(attention * pull, begin[:-1]), sizes))
        gate = dlogit[:, None] * w["a"]
        dv, du = gate * u * (1 - v * v), gate * v * u * (1 - u)
        dh = dz * attention[:, None] + dv @ w["V"].T + du @ w["U"].T
        inner = dh * (1 - h * h)
        return {
            "W": x.T @ inner, "b": inner.sum(0), "V": h.T @ dv, "U": h.T @ du,
            "a": (dlogit[:, None] * v * u).sum(0), "c": z.T @ slope, "d": slope.sum(keepdims=True),
        }

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.w)
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as stored:
            return cls({k: stored[k] for k in stored.files})


def trained(bags: list[np.ndarray], y: np.ndarray) -> Model:
    """Adam in a fixed random order, EPOCHS rounds and about STEPS steps at least; both classes weigh the same."""
    if not len(y) or y.min() == y.max():
        return Model.constant(float(y.mean()) if len(y) else 0.5)
    everything = np.concatenate(bags)
    model = Model.fresh(everything.mean(0), everything.std(0) + 1e-2)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    r = np.random.default_rng(11)
    first = {k: 0.0 for k in "WbVUacd"}
    second, step = dict(first), 0
    epochs = max(EPOCHS, STEPS * BATCH // len(y))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = r.permutation(len(y))
        for i in range(0, len(y), BATCH):
            rows = order[i : i + BATCH]
            begin = np.concatenate([[0], np.cumsum([len(bags[j]) for j in rows])])
            step += 1
            for k, g in model.gradients(np.concatenate([bags[j] for j in rows]), begin, y[rows], weight[rows]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                model.w[k] -= rate * (change + DECAY * model.w[k])
    return model


def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in blocks(batch, "text"):
            x, begin = passages(data, offsets)
            bags = [x[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
            yield pa.record_batch([batch.column(0)[rows], batch.column(1)[rows], pa.array(bags, pa.binary())], names=["id", "label", "bag"])


def fitted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["id", "bag"])
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in frame.bag]
    return pd.DataFrame({"model": [trained(bags, frame.label.to_numpy(np.float64)).packed()]})


def held_out(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % 3 == 1


def fit(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> bytes:
    """The packed weights, a few tens of kB."""
    ship_package(documents.sparkSession)
    usable = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    usable = usable.filter(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"))
    some = usable.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(some), "id").select("id", "label", "text")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    bags = rows.mapInArrow(encoded, f"id {kinds['id']}, label int, bag binary")
    model = bags.withColumn("task", F.lit(0)).groupBy("task").applyInPandas(fitted, "model binary").collect()
    return bytes(model[0].model) if model else Model.constant(0.5).packed()


def scored(documents: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """(row, score): every row as it is, as a struct, and its score."""
    ship_package(documents.sparkSession)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.unpacked(model)
        for batch in batches:
            texts = pa.record_batch([batch.column(0).field(text)], names=["text"])
            values = [own.forward(*passages(data, offsets))[-1] for _, data, offsets in blocks(texts, "text")]
            yield pa.record_batch([batch.column(0), pa.array(np.concatenate(values) if values else np.empty(0))], names=["row", "score"])

    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    return rows.mapInArrow(scores, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def quality_scores(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = fit(documents, labels, id, text)
    found = scored(documents.select(id, text), model, text)
    key = F.col(f"row.{id}")
    return found.select(key.alias(id), held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
