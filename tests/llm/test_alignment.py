from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from plaintide.llm import alignment
from plaintide.llm.queries import op11_alignment
from tests.conftest import SF_DIR

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PLACES = list("abc theE 's12.,!  \n\n\t  \x1c\x85é中文😀▁'<>|ﬁ́") + ["<|endoftext|>", "<s>", "<0x0A>", " the", " don't", "  "]


@pytest.fixture(scope="module")
def plainly():
    """(A ids, B ids, groups, links) of a text, from the libraries and a walk over both ends."""
    own = alignment.vocabularies(A, B)
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True

    def aligned(text):
        if not text:
            return [], [], [], []
        a, b = first.encode(f" {text}", add_special_tokens=False).ids, second.encode(text)
        parts = [own.a_bytes[i] for i in a], [own.b_bytes[i] for i in b]
        if any(b"".join(p) != f" {text}".encode() for p in parts):
            return [], [], [], []
        ends = [np.cumsum([len(t) for t in p]).tolist() for p in parts]
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            links.append((a[k - 1], b[m - 1]))
            i, j = k, m
        return a, b, groups, links

    return aligned


def rows_of(texts, stretch):
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])
    return {r["id"]: r for out in alignment.aligner(A, B, stretch)(iter([batch])) for r in out.to_pylist()}


@pytest.mark.parametrize("stretch", [7, 300])
def test_random_texts(plainly, stretch):
    r = random.Random(11)
    texts = [None, "", " ", "a", "  a ", "\n", " \n ", "a\n b", "x" * 2000]
    texts += ["".join(r.choice(PLACES) for _ in range(r.randint(1, 40))) for _ in range(3000)]
    own = alignment.vocabularies(A, B)
    found = rows_of(texts, stretch)
    for i, text in enumerate(texts):
        a, b, groups, links = plainly(text)
        row = found[i]
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"]) == (len(a), len(b), len(groups), len(links)), repr(text)
        assert row["groups"] == ";".join(groups), repr(text)
        assert [divmod(int(own.codes[k]), len(own.b_bytes)) for k in row["links"]] == links, repr(text)


def test_generations_forget_and_keep_results(plainly, monkeypatch):
    texts = [f"word{i} other{i % 3} ﬁ{i}" for i in range(60)]
    before = rows_of(texts, 40)
    monkeypatch.setattr(alignment.vocabularies(A, B).recent, "limit", 5)
    assert rows_of(texts, 40) == before


def test_table(spark, plainly):
    """The query on its whole table against counts of links found one by one."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    plain = {i: plainly(t) for i, t in docs.items()}
    count = Counter(link for _, _, _, links in plain.values() for link in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    got = op11_alignment(spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for row in got:
        a, b, groups, links = plain[row.doc_id]
        text = ";".join(groups)
        assert row.asDict() == {
            "doc_id": row.doc_id, "n_a": len(a), "n_b": len(b), "n_groups": len(groups), "n_links": len(links),
            "n_best": sum(count[x] == most[x[1]] for x in links), "count_sum": sum(count[x] for x in links),
            "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if a else "",
        }


def test_edges(spark, documents):
    docs = documents([(1, "one two"), (1, "one two"), (None, "one"), (2, None), (3, ""), (4, "a▁b")])
    aligned = alignment.align(docs, A, B).cache()
    rows = sorted(alignment.linked_counts(aligned, A, B).collect(), key=str)
    assert [r.n_a for r in rows if r.doc_id in (2, 3, 4)] == [0, 0, 0]
    twice = [r for r in rows if r.doc_id == 1]
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].count_sum == 3 + 2 and twice[0].n_best == 2
    none = alignment.align(documents([]), A, B)
    assert alignment.linked_counts(none, A, B).collect() == []
