"""Texts whose hashes would collide modulo a power of two, and operators under a hash of eight bits."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from plaintide.llm import blocks, line_dedup, quality_rules
from plaintide.llm.hyperminhash import forest, near_dedup, sequence_keys, verified
from plaintide.llm.line_dedup import line_dedup as lines
from plaintide.llm.quality_rules import quality_rules as rules


def alternating(size):
    """The Thue-Morse word over a and b, and its complement."""
    bits = [bin(i).count("1") & 1 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [1024, 4096, 1 << 15])
def test_alternating_words(documents, size):
    x, y = alternating(size)
    near = {r.doc_id: r.component_id for r in near_dedup(documents([(1, x), (2, y)]), words=3, percent=85).collect()}
    assert near == {1: 1, 2: 2}
    some = " ".join(f"w{i}" for i in range(40))
    assert rules(documents([(1, f"{some}\n{x}\n{y}\n{x}")])).first().n_dup_lines == 1
    kept = {r.doc_id: r.text for r in lines(documents([(1, f"{x}\n{y}"), (2, x), (3, x), (4, x)])).collect()}
    assert kept == {1: y, 2: "", 3: "", 4: x}


@pytest.fixture
def weak(monkeypatch):
    """Span hashes of eight bits; for code that runs in this process."""
    strong = blocks.SpanHash.between
    monkeypatch.setattr(blocks.SpanHash, "between", lambda *a: strong(*a) & np.uint64(255))


def batch_of(texts, **more):
    return pa.record_batch([pa.array(range(len(texts)), pa.int64()), *more.values(), pa.array(texts)], names=["id", *more, "text"])


def test_weak_hash_rules(weak):
    r = random.Random(2)
    text = "\n".join(" ".join(r.choice("abcdefgh") for _ in range(r.choice([3, 9]))) for _ in range(600))
    row = next(quality_rules.measured(iter([batch_of([text, text[::-1]])]))).to_pylist()
    for found, own in zip(row, (text, text[::-1]), strict=True):
        split, words = own.split("\n"), own.split()
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
        assert (found["n_dup_lines"], found["n_repeat_words"]) == (len(split) - len(set(split)), len(covered))


def test_weak_hash_lines(weak):
    class Held:
        value = 20, b"\xff" * (1 << 17)

    texts = ["\n".join(f"a line of some length {i * j % 7}" for i in range(40)) for j in (1, 2, 0)]
    found = pa.Table.from_batches(line_dedup.suspects(Held, 20)(iter([batch_of(texts, mark=pa.array([0, 0, 0], pa.int64()))]))).to_pylist()
    assert sorted((r["id"], r["key"].decode()) for r in found) == sorted((i, line) for i, t in enumerate(texts) for line in set(t.split("\n")))
    gone = texts[0].split("\n")[3]
    hashes = [int(r["hash"]) for r in found if r["key"].decode() == gone]
    drops = pa.array([[{"hash": hashes[0], "sha": hashlib.sha256(gone.encode()).digest()}]] * 3, pa.list_(pa.struct([("hash", pa.int64()), ("sha", pa.binary())])))
    rest = pa.Table.from_batches(line_dedup.dropper(20)(iter([batch_of(texts, drops=drops)]))).column("text").to_pylist()
    assert rest == ["\n".join(x for x in t.split("\n") if x != gone) for t in texts]


def test_lines_of_a_block_are_found_at_once(monkeypatch):
    """One document at a time, the small steps of the search cost more than the lines."""
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("sha", pa.binary())]))
    gone = "a line of more than twenty"
    own = line_dedup.Lines(np.frombuffer(gone.encode(), np.uint8), np.array([0, len(gone)]), 20)
    drop = [{"hash": int(own.hash.view(np.int64)[0]), "sha": hashlib.sha256(gone.encode()).digest()}]
    texts = [f"{gone}\nx", f"{gone}\ny", None, f"\n {gone.upper()}\n", "", gone]
    calls, lines_of = [], line_dedup.Lines
    monkeypatch.setattr(line_dedup, "Lines", lambda *a: calls.append(1) or lines_of(*a))
    drops = pa.array([drop, None, None, drop, [], drop], kind)
    rest = pa.Table.from_batches(line_dedup.dropper(20)(iter([batch_of(texts, drops=drops).slice(0), batch_of(["z", *texts], drops=pa.array([None, drop, None, None, drop, [], drop], kind)).slice(1)]))).to_pydict()
    assert rest["text"] == ["x", f"{gone}\ny", "", "\n", "", ""] * 2
    assert rest["n_lines"] == [2, 2, 1, 3, 1, 1] * 2 and rest["n_dropped"] == [1, 0, 0, 1, 0, 1] * 2
    assert len(calls) == 2


def test_weak_hash_links(weak):
    """Only true links come out of the confirmation, however alike the hashes make sets look."""
    import pandas as pd

    r = random.Random(4)
    base = [f"w{r.randint(0, 500)}" for _ in range(900)]
    texts = [" ".join(base), " ".join([*base[:880], *["x"] * 20]), " ".join(f"v{i}" for i in range(900))]
    frame = pd.DataFrame({"node": [1, 2, 3], "component": [1, 2, 3], "text": texts})
    pairs = [(0, np.array([1, 2])), (1, np.array([2]))]
    assert forest(frame, pairs, 3, 85) == [(2, 1)]


def test_sequence_keys():
    texts = ["a b", " A\t\nB ", "ab", "", " ", "a  b c", "é É", "x" * 10]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    assert sequence_keys(data, offsets) == [hashlib.sha256(" ".join(t.translate(low).split()).encode()).digest() for t in texts]


def test_pairs_are_confirmed_by_words(spark):
    x, y = alternating(2048)
    texts = spark.createDataFrame([(1, f"{x} p q r"), (2, f"{y} p q r"), (3, f"{x} p q r s")], "node long, text string")
    pairs = spark.createDataFrame([(2, 1), (3, 1)], "a long, b long")
    assert verified(pairs, texts, 1, 75).collect() == [(3, 1)]
