"""Token counts and SentencePiece coding against a plain search, the library itself and round trips."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from plaintide.llm.sentencepiece_codec import Codec, StreamingViterbi, decode, encode
from plaintide.llm.token_counts import Trie, token_counts
from plaintide.llm.unigram import SPACE, escaped, unigram
from tests.conftest import SF_DIR

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "a", "  two  spaces ", "line\n\nbreaks\n", "tabs\tand\rreturns", "naïve Übergröße", "日本語のテキスト", "\U0001f600 smile",
    "x" * 500, "antidisestablishmentarianism and internationalization", "a b", "0x00 <0x41> </s>", "\n", "é" * 90 + " end",
]


def plain_search(model, text):
    """The whole table at once: ids of the best path, of equal ones the earliest last start."""
    best, back = [0.0] + [None] * len(text), [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - model.longest), end):
            score = model.scores.get(text[start:end], model.unknown if start == end - 1 else None)
            if score is not None and (best[end] is None or best[start] + score > best[end]):
                best[end], back[end] = best[start] + score, start
    ids, end = [], len(text)
    while end:
        piece = text[back[end]:end]
        ids[:0] = [model.ids[piece]] if piece in model.ids else model.spelled(piece)
        end = back[end]
    return ids


@pytest.fixture(scope="module")
def corpus(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()
    return [r.text for r in rows]


def test_codec_equals_the_whole_table(corpus):
    codec, model = Codec(PATH), unigram(PATH)
    texts = TEXTS + [t[:700] for t in corpus]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain_search(model, escaped(text)), text[:50]
        assert codec.decode(ids).decode() == text


def test_ids_score_at_least_as_well_as_the_library_in_unigram_mode(corpus):
    """The library's own search gives the same ids, but for a few words where it misses a better path."""
    proto = pb.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    codec, words = Codec(PATH), sorted({w for t in corpus for w in t.split() if w.isalpha()})
    assert len(words) > 1000
    better = 0
    for word, packed, theirs in zip(words, codec.encode(words), library.encode(words), strict=True):
        ours = np.frombuffer(packed, "<u4").tolist()
        gain = sum(map(library.get_score, ours)) - sum(map(library.get_score, theirs))
        assert (ours == theirs if gain == 0 else gain > 0), word
        better += gain > 0
    assert better < len(words) / 100


def test_search_holds_a_window_only(corpus):
    text = escaped("".join(corpus[0].split()) * 200)
    search = StreamingViterbi(unigram(PATH))
    ids = list(search.encode(iter(text)))
    assert search.held < 1024 < len(text)
    assert "".join(unigram(PATH).pieces[i] for i in ids) == text


def test_counts_equal_ids(spark, documents, corpus):
    texts = dict(enumerate([*TEXTS, *corpus]))
    frame = documents(texts)
    counts = {r.doc_id: r.n_tokens for r in token_counts(frame, PATH).collect()}
    coded = {r.doc_id: len(r.ids) // 4 for r in encode(frame, PATH).collect()}
    assert counts == coded and len(counts) == len(texts)


def test_a_shared_prefix_is_scored_once():
    trie = Trie(unigram(PATH))
    trie.counts(["international"])
    before = len(trie.nodes)
    trie.counts(["internationally"])
    assert len(trie.nodes) == before + 2 and SPACE + "international" in trie.terminals


def test_nulls_and_empty_tables(spark, documents):
    rows = documents([(None, None), (1, None), (1, "a b"), (1, "a b")])
    assert sorted(r.n_tokens for r in token_counts(rows, PATH).collect()) == [0, 0, 2, 2]
    back = decode(encode(rows, PATH), PATH).collect()
    assert sorted(r.decoded for r in back) == ["", "", "a b", "a b"]
    empty = rows.limit(0)
    assert token_counts(empty, PATH).collect() == [] and decode(encode(empty, PATH), PATH).collect() == []
