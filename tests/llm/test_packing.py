"""Packing: a round trip of the ids, the places, and the fit against a plain search."""

from __future__ import annotations

import collections
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plaintide.llm.packing import Encoder, best_fit, pack, sequences
from tests.conftest import SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.json")


def checked(frame, pieces, texts):
    tokenizer = Tokenizer.from_file(PATH)
    rows, by_doc, by_sequence = pieces.collect(), collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc.pop(i), key=lambda r: r.start)
        assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == ids
        assert {r.doc_tokens for r in own} == {len(ids)}
    assert not by_doc
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return rows


def test_table(spark):
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = pack(frame, PATH)
    rows = checked(frame, pieces, {r.doc_id: r.text for r in frame.collect()})
    tokens, padding = sum(r.length for r in rows), sequences(pieces).agg({"padding": "sum"}).first()[0]
    assert padding < 0.05 * tokens


@pytest.mark.parametrize("text", [
    "", None, " ", "  a  b \n\n c\t\td \r\n e  ", "it's we'll  'tis\n'd", "a b\x85 c\x1cd\x0b e  \x0c f  g", "日本語 text \U0001f600 ok", "x" * 20000,
    "<|endoftext|> inside", "word " * 3000, "\n a\n  b\n", "tab\t word", "1 2  3", " leading", "a  b　c",
])
def test_texts(documents, text):
    frame = documents({1: text})
    checked(frame, pack(frame, PATH), {1: text})


def test_batches_nulls_and_empty_tables(documents):
    rows = [(i, "word " * (i * 37 % 1500)) for i in range(60)]
    frame = documents(rows)
    checked(frame, pack(frame, PATH, pieces=7), dict(rows))
    assert sorted(r.length for r in pack(documents([(None, "a"), (None, "a")]), PATH).collect()) == [2, 2]
    assert pack(frame.limit(0), PATH).collect() == []


def test_best_fit_equals_a_plain_search():
    r = random.Random(1)
    lengths = [r.randint(1, 1023) for _ in range(400)]
    room, placed = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [c for c in room if c >= lengths[i]]
        best = min(fits) if fits else 1024
        if fits:
            room.remove(best)
        room.append(best - lengths[i])
        placed[i] = 1024 - best
    where, offset, used = best_fit(lengths, 1024)
    assert offset == placed and used == len(room) and len(set(where)) == used


def test_a_text_is_encoded_in_one_call():
    own, calls = Encoder(PATH), []
    plain = own.plain
    own.plain = lambda text, **how: calls.append(text) or plain(text, **how)
    text = "some words,  some\n words and others " * 50
    assert np.frombuffer(own.encode(text), "<u4").tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert calls == [text]
