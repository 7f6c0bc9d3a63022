"""Quality rules against a plain version of every count."""

from __future__ import annotations

import base64
import collections
import random
import re

import pytest
import zstandard

from plaintide.llm import quality_rules as rules
from tests.conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    times = collections.Counter(windows)
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    raw = text.encode()
    compress = zstandard.ZstdCompressor(level=3).compress
    ratio = len(raw) / len(compress(raw)) if raw else 0.0
    low, high = [(b, c) for a, b, c in rules.BANDS if len(raw) >= a][-1]
    chunks = [raw[i : i + 4096] for i in range(0, len(raw) - 4095, 4096)]
    outside = sum(not 1.2 <= 4096 / len(compress(c)) <= 3.5 for c in chunks)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    kept = not failed and low <= ratio <= high and outside <= 0.2 * len(chunks)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, lines, len(covered), failed, kept)


def found(frame):
    rows = rules.quality_rules(frame).collect()
    return [(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)) for r in rows]


def test_documents(spark):
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in frame.collect()}
    got = dict(found(frame))
    assert got == {i: plain(t) for i, t in texts.items()}
    assert {v[-1] for v in got.values()} == {True, False}


def test_edges(documents):
    r = random.Random(7)
    noise = " ".join("".join(r.choices("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/", k=40)) for _ in range(200))
    prose = " ".join("".join(r.choices("etaoin shrdlu", k=6)) for _ in range(3000))
    texts = {
        1: None, 2: "", 3: " \n\t", 4: "a\nb\n\na\n \na\r", 5: "one two three four five six seven eight " * 9, 6: noise, 7: prose,
        8: "naïve Größe 日本 語" * 30, 9: "a b\x85c\x1cd", 10: prose + " " + "zz top " * 4000, 11: "#a *b\n#a *b\n" * 30,
    }
    got = dict(found(documents(texts)))
    assert got == {i: plain(t) for i, t in texts.items()}
    assert got[7][-1] and not got[10][-1] and not got[5][-1]


def test_repeated_rows_and_empty_tables(documents):
    rows = documents([(None, "x"), (1, "x"), (1, "x")])
    assert [v for _, v in found(rows)] == [plain("x")] * 3
    assert found(rows.limit(0)) == []


def encoded(size, seed=0, line=76):
    text = base64.b64encode(random.Random(seed).randbytes(size)).decode()
    return "\n".join(text[i : i + line] for i in range(0, size, line))[:size]


@pytest.fixture(scope="module")
def clean(spark):
    """Clean rows by their labels, of each language."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/../sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = docs.join(labels.filter("quality = 1").select("doc_id"), "doc_id").collect()
    return [r for r in rows if len(r.text.encode()) >= 192]


def verdicts(documents, texts):
    return [r.kept for r in sorted(rules.quality_rules(documents(list(enumerate(texts)))).collect(), key=lambda r: r.doc_id)]


def test_base64_at_the_ends_of_the_bands(documents):
    """Below 1,540 bytes such texts have too few words as well, so the limits are looked at by themselves."""
    starts = [a for a, *_ in rules.BANDS][2:]
    sizes = sorted({*starts, *(a - 1 for a in starts[1:]), 1600, 3000, 12000, 16000, 17000, 60000})
    texts = [encoded(n, s, line) for n in sizes for s in range(3) for line in (64, 76, 10**6)]
    frame = rules.quality_rules(documents(list(enumerate(texts))))
    assert [r.doc_id for r in frame.filter(rules.within_bands()).collect()] == []
    assert not any(verdicts(documents, texts))


def test_base64_as_part_of_a_long_text(documents, clean):
    long = [r.text for r in clean if len(r.text) >= 20000]
    assert long and not any(verdicts(documents, [t[:20000] + "\n" + encoded(20000, i) for i, t in enumerate(long)]))


def test_clean_texts_of_each_language_are_inside(documents, clean):
    assert {r.lang for r in clean} == {"en", "de", "fr", "es"}
    frame = rules.quality_rules(documents([(r.doc_id, r.text) for r in clean]))
    assert frame.filter(~rules.within_bands() | (rules.F.col("n_chunks_outside") > 0)).collect() == []


def cut(text, size):
    return text.encode()[:size].decode("utf-8", "ignore")


@pytest.mark.parametrize("size,junk", [(4096, 2500), (2500, 2500), (2500, 1500), (2000, 2000), (1000, 600), (6000, 2500)])
def test_junk_without_words_at_the_end(documents, clean, size, junk):
    texts = [cut(r.text, size) for r in clean if len(r.text.encode()) >= size]
    assert texts and all(verdicts(documents, texts))
    assert not any(verdicts(documents, [t + "=-=-" * (junk // 4) for t in texts]))


@pytest.mark.parametrize("before,size,after", [(4096, 4000, 0), (2000, 3000, 3000), (1500, 900, 0), (0, 1000, 3000), (9000, 5000, 4000)])
def test_base64_among_prose(documents, clean, before, size, after):
    texts = [r.text for r in clean if len(r.text) >= before + after]
    assert texts
    mixed = [t[:before] + "\n" + encoded(size, i) + "\n" + t[before : before + after] for i, t in enumerate(texts)]
    assert not any(verdicts(documents, mixed))


def test_parts_are_small_and_cover_the_text():
    for size in (1, 255, 2047, 2048, 4095, 4096, 9000, 32767, 32768, 10**6):
        step = rules.part_size(size)
        assert rules.CHUNK % step == 0 and rules.PART <= step <= max(size // 8, rules.PART)
    compress = zstandard.ZstdCompressor(level=3).compress
    raw = random.Random(1).randbytes(9001)
    assert rules.ratios(raw, compress)[1:] == (3, 3, 9001)
