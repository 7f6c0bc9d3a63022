"""The pipeline stage by stage against plain versions, and as a whole."""

from __future__ import annotations

import collections

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plaintide.llm.quality_classifier import quality_scores
from tests.conftest import SF_DIR
from tests.llm.test_dedup import plain_exact, plain_near, texts_of

STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def kept(frame, ids):
    return rows_of(frame.filter(frame.doc_id.isin(list(ids))))


def plain_rest(rows, width=200):
    """Texts without the bytes of repeated strings, whole characters only."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[j : j + width] for _, b in raw for j in range(len(b) - width + 1))
    out = {}
    for i, b in raw:
        covered = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if seen[b[j : j + width]] > 1:
                covered[j : j + width] = b"\1" * width
        out[i] = bytes(x for x, c in zip(b, covered, strict=True) if not c).decode("utf-8", "ignore")
    return out


def test_quality_keeps_what_is_predicted_good(spark, table):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = {r.doc_id for r in quality_scores(table, labels).collect() if r.predicted}
    assert rows_of(STAGE["quality_classifier"](spark, table, SF_DIR)) == kept(table, good)


def test_exact_keeps_one_of_each_text(spark, table):
    good = {i for i, *_, keep, _ in plain_exact(texts_of(table)) if keep}
    assert rows_of(STAGE["exact_dedup"](spark, table, SF_DIR)) == kept(table, good)


def test_near_keeps_one_of_each_group(spark, table):
    good = {i for i, (_, _, keep) in plain_near(texts_of(table), 5, 80).items() if keep}
    assert rows_of(STAGE["near_dedup"](spark, table, SF_DIR)) == kept(table, good)


def test_passages_are_cut_from_the_texts(spark, table):
    rest = plain_rest(texts_of(table))
    found = STAGE["suffix_dedup"](spark, table, SF_DIR)
    assert found.schema == table.schema
    assert {r.doc_id: (r.text, r.n_chars) for r in found.collect()} == {i: (t, len(t)) for i, t in rest.items()}


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = collections.defaultdict(list)
    for r in sorted(pieces, key=lambda r: r.start):
        by_doc[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    texts = dict(texts_of(docs))
    assert dict(by_doc) == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}


def test_edges(spark, documents):
    text = "some words that are long enough to be a text of its own, and a few more of them " * 4
    docs = documents([(None, None), (1, None), (2, ""), (3, text), (3, text), (None, text), (5, text + "x"), (6, " \n")])
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_DIR).collect() == []
    exact = sorted([(r.doc_id, r.text) for r in STAGE["exact_dedup"](spark, docs, SF_DIR).collect()], key=repr)
    assert exact == sorted([(3, text), (3, text), (5, text + "x"), (6, " \n")], key=repr)


def words(seed, count=60):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("etaoinshrdlu"), 7)) for _ in range(count))


def test_repeated_rows_null_ids_and_shared_ids_through_all_stages(spark, documents):
    a, b, c, d, e, f = (words(i) for i in range(6))
    near_f = f.replace(f.split(" ")[30], "changed")
    rows = [
        (1, a), (1, a), (None, a), (None, a),  # a repeated row, and copies of it without ids
        (None, b), (None, b), (None, c),  # documents of their own without ids
        (3, d), (4, d), (4, e),  # an id that is shared by a copy and another document
        (5, f), (None, near_f), (5, near_f),  # near copies without an id, and under the id itself
        (None, c.replace(" ", "  ")), (7, None), (7, ""), (None, None),
    ]
    docs = documents(rows)
    for name in ("exact_dedup", "near_dedup"):
        docs = spark.createDataFrame(STAGE[name](spark, docs, SF_DIR).collect(), docs.schema)
    (kept_f,) = [r.text for r in docs.collect() if r.doc_id == 5]
    assert kept_f in (f, near_f)
    texts = sorted([(r.doc_id, r.text) for r in docs.collect() if r.text], key=repr)
    assert texts == sorted([(1, a), (None, b), (None, c.replace(" ", "  ")), (3, d), (4, e), (5, kept_f)], key=repr)
    assert [r.doc_id for r in docs.collect() if not r.text] == [7]
    rest = STAGE["suffix_dedup"](spark, docs, SF_DIR)
    assert rows_of(rest) == rows_of(docs)
    pieces = STAGE["packing"](spark, rest.filter("doc_id is not null"), SF_DIR).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in texts:
        if i is not None:
            ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(pieces, key=lambda r: r.start) if r.doc_id == i])
            assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_exact_tells_the_texts_of_one_id_apart(spark, documents):
    docs = documents([(3, "some words"), (None, "some words"), (None, "other words"), (4, "a text"), (4, "some words"), (5, "a b"), (5, "ab")])
    found = sorted([(r.doc_id, r.text) for r in STAGE["exact_dedup"](spark, docs, SF_DIR).collect()], key=repr)
    assert found == sorted([(3, "some words"), (None, "other words"), (4, "a text"), (5, "a b")], key=repr)
