"""The classifier on rows it has not seen, its gradients, and tables without labels."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from plaintide.llm import quality_classifier as q
from tests.conftest import SF_DIR

ROOT = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    documents, labels = (spark.read.parquet(f"{ROOT}/{n}.parquet") for n in ("documents", "labels"))
    rows = q.quality_scores(documents, labels).collect()
    assert len(rows) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    new = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = np.array([s for s, y in new if y]), np.array([s for s, y in new if not y])
    assert (good[:, None] > bad).mean() > 0.97
    assert np.mean([(s >= 0.5) == y for s, y in new]) > 0.95


def plain_features(words, raw):
    """One passage, from its words and its bytes, spaces after them included."""
    kinds, bags = np.zeros(q.CLASSES), np.zeros(q.WORD_BUCKETS)
    for byte in raw:
        kinds[byte - 32 if 32 <= byte < 127 else 95 if byte == 10 else 96 if byte < 128 else 97 if byte >= 0xC0 else 98] += 1
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    for word in low:
        data = np.frombuffer(word, np.uint8)
        bags[int(q.SpanHash.of_bytes(data).spans(np.array([0]), np.array([len(data)]))[0]) % q.WORD_BUCKETS] += 1
    n, letters = max(len(words), 1), sum(map(len, words))
    shares = [len(set(low)) / n, np.log1p(letters / n), len(words) / q.PASSAGE, np.log1p(len(raw))]
    return np.concatenate([np.sqrt(kinds / max(len(raw), 1)), np.sqrt(bags / n), shares])


def plain_score(w, text):
    """One document, passage by passage and number by number."""
    raw = (text or "").encode()
    places = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    starts = [0, *(places[i][0] for i in range(q.PASSAGE, len(places), q.PASSAGE))]
    logits, hidden = [], []
    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(raw)], strict=True)):
        x = plain_features([raw[i:j] for i, j in places[q.PASSAGE * k : q.PASSAGE * (k + 1)]], raw[a:b])
        x = np.clip((x - w["mean"]) / w["scale"], -8, 8)
        h = [math.tanh(sum(x * w["W"][:, j]) + w["b"][j]) for j in range(q.HIDDEN)]
        gates = [math.tanh(np.dot(h, w["V"][:, j])) / (1 + math.exp(-np.dot(h, w["U"][:, j]))) for j in range(q.GATE)]
        logits.append(np.dot(gates, w["a"]))
        hidden.append(h)
    shares = [math.exp(v - max(logits)) for v in logits]
    z = sum(s * np.array(h) for s, h in zip(shares, hidden, strict=True)) / sum(shares)
    return 1 / (1 + math.exp(-(np.dot(z, w["c"]) + w["d"][0])))


def test_scores_against_a_plain_version(spark):
    """Every document of the table, the very long ones too, and awkward ones."""
    documents, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    model = q.fit(documents, labels)
    weights = q.Model.unpacked(model).w
    edges = [None, "", " \n", "Ä é 日本 x\x00y", "w " * 64, " lead " * 65, "A a B b\n" * 40, "x" * 5000]
    more = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(edges)], "doc_id long, text string")
    found = q.scored(documents.select("doc_id", "text").unionByName(more), model).select("row.text", "score").collect()
    assert len(found) == documents.count() + len(edges)
    assert max(abs(r.score - plain_score(weights, r.text)) for r in found) < 1e-5


def test_gradients():
    r = np.random.default_rng(1)
    x, begin, y = r.normal(size=(9, q.FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    model, weight = q.Model.fresh(np.zeros(q.FEATURES), np.ones(q.FEATURES)), np.array([1.0, 2.0, 0.5])

    def loss():
        p = model.forward(x, begin)[-1]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()

    for name, gradient in model.gradients(x, begin, y, weight).items():
        values = model.w[name].reshape(-1)
        for at in (0, len(values) // 2, len(values) - 1):
            kept, step = values[at], 1e-5
            values[at] = kept + step
            up = loss()
            values[at] = kept - step
            down = loss()
            values[at] = kept
            assert abs((up - down) / (2 * step) - gradient.reshape(-1)[at]) < 1e-6, name


def test_attention_finds_the_bad_passage(documents, spark):
    """Bad documents differ in one passage of many; the score of a document follows it."""
    clean, junk = "all is well here and there " * 60, "$$$ ### %%% &&& " * 16
    rows = [(i, clean[: 900 + 7 * i] + (junk if i % 2 else "")) for i in range(120)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "doc_id long, quality int")
    got = q.quality_scores(documents(rows), labels).collect()
    assert sum(r.predicted == 1 - r.doc_id % 2 for r in got) >= 117


def test_edges(documents, spark):
    rows = documents([(None, "x"), (1, None), (1, ""), (2, " \n"), (3, "w " * 50_000)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in q.quality_scores(rows, none).collect()] == [0.5] * 5
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 1), (3, 1)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in q.quality_scores(rows, one).collect())
    assert q.quality_scores(rows.limit(0), one).collect() == []
    kept = q.scored(rows, q.fit(rows, one)).select("row.*")
    assert kept.columns == rows.columns and kept.agg(F.sum("score")).first()[0] == 35
