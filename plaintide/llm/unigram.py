"""A unigram model's pieces and scores, read from a SentencePiece file, and how texts fall into chunks for it.

The vocabulary's scores are taken as log probabilities: the best segmentation is the one with the greatest sum,
of equal ones the one whose last piece is longest, and so on back. A character that no single-character piece
covers is spelled with byte pieces.

Spaces become ``SPACE`` and a text gets one in front. A piece has ``SPACE`` only at its begin or consists of it, and
no piece has a line feed, which is checked when a model is loaded; so every best path has a boundary before a
space that follows something else, and around a line feed. Texts are cut there into chunks.
"""

from __future__ import annotations

import re
from functools import cached_property, lru_cache

SPACE = "▁"
#: The key of a piece's score in its node of the trie; characters are the keys of the nodes below.
SCORE = ""
CHUNK = re.compile(r"▁*[^▁\n]+|\n|▁+")
#: A character without a piece costs this much more than the worst piece.
UNKNOWN = 10.0


class Unigram:
    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        plain = [i for i in range(len(model)) if not any(f(i) for f in special)]
        self.pieces = [model.id_to_piece(i) for i in range(len(model))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = min(self.scores.values()) - UNKNOWN
        self.longest = max(map(len, self.scores))
        self.prefixes = {p[:k] for p in self.scores for k in range(1, len(p))}
        self.suffixes = {p[k:] for p in self.scores for k in range(1, len(p))}
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("a piece goes across a chunk's border")
        if any(model.is_unknown(b) for b in self.bytes):
            raise ValueError("the model has no byte pieces")

    @cached_property
    def trie(self) -> dict:
        """The pieces by their characters."""
        root: dict = {}
        for piece, score in self.scores.items():
            node = root
            for character in piece:
                node = node.setdefault(character, {})
            node[SCORE] = score
        return root

    def spelled(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode()]


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    return Unigram(path)


def escaped(text: str) -> str:
    """The text as the model sees it; an empty text stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""
