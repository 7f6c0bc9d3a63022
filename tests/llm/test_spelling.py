from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plaintide.llm import spelling
from plaintide.llm.queries import op13_spelling
from tests.conftest import SF_DIR

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_words(rows, every):
    count = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def plain_variants(words):
    """Near words by the words without one code point, checked one by one."""

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    cut = {}
    for w in words:
        for shape in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            cut.setdefault(shape, set()).add(w)
    found = {w: set() for w in words}
    for group in cut.values():
        for a in group:
            found[a].update(b for b in group if b != a and b not in found[a] and near(a, b))
    form = {}
    for w, others in found.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= 10 * words[w]:
                form[w] = best
    rows = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows[w] = (n, form.get(w), root, len(found[w]), words[form[w]] if w in form else None)
    return rows


def got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.form, r.root, r.n_near, r.form_n) for r in rows}


def test_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    words = plain_words([tuple(r) for r in docs], 31)
    found = got(op13_spelling(spark, SF_DIR))
    assert found == plain_variants(words)
    assert sum(r[3] for r in found.values()) > 100 and any(r[1] for r in found.values())


@pytest.mark.parametrize("tile", [2, 7, 256])
def test_alike_words(spark, tile):
    """Words over few letters, whose blocks go through all halvings where tiles are small."""
    r = random.Random(13)
    words = {}
    for _ in range(1500):
        words["".join(r.choice("abé") for _ in range(r.choice([7, 8, 8, 9, 12])))] = r.choice([2, 3, 25, 260, 3000])
    words |= {"a" * k: 10**k for k in range(7, 13)} | {"x" * 300: 2, "x" * 299 + "y": 50, "x" * 301: 600}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.spelling_variants(frame, tile=tile)) == plain_variants(words)


def test_edges(spark, documents):
    rows = [(1, "Accommodation accommodation, ACCOMMODATION"), (1, "accommodation " * 20), (None, "acommodation acommodation"), (2, None), (3, ""),
            (4, "Éclair-s éclairs Éclairs " + "z" * 90_000 + " " + "z" * 90_000), (5, "naïveté中naïveté \u2019naïveté short x1234567")]
    words = plain_words(rows, 5)
    vocabulary = spelling.vocabulary(documents(rows), delete_every=5)
    assert {r.word: r.n for r in vocabulary.collect()} == words
    assert got(spelling.spelling_variants(vocabulary)) == plain_variants(words)
    assert spelling.spelling_variants(spelling.vocabulary(documents([]))).collect() == []


def test_ties_take_the_least_word(spark):
    words = {"bananas": 40, "bananat": 40, "bananax": 2, "cananax": 4}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = got(spelling.spelling_variants(frame.withColumn("key", F.lit(1))))
    assert found == plain_variants(words) and found["bananax"][1] == "bananas"
