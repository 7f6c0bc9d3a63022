"""Byte-level vocabularies: the bytes of tokens, units of text that no token spans, and a fast encoder for them."""

from __future__ import annotations

import json
import re

#: The split of byte-level BPE before merging: contractions, letters, digits, marks, white space.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: No token spans a space between another character and a solid one.
CUT = re.compile(r"(?<=[^ ])(?= \S)")
#: White space that is not one space before a solid character.
UNEVEN = re.compile(r"^\s| (?:\s|$)")
#: Longer units are not kept for later.
LONGEST = 64


def units_of(text: str) -> list[str]:
    """The units of a space and a text, each without its space: no token spans two of them. Joined by spaces they are the text."""
    if UNEVEN.search(text) is None:
        return text.split(" ")
    return [u[1:] for u in CUT.split(f" {text}")]


class Recent:
    """Values of the units used of late: two generations of ``limit`` units each, beside those of one call."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def fresh(self, units: set[str]) -> list[str]:
        """The units without a value; those of the older generation become young."""
        young, old = self.young, self.old
        missing = units.difference(young)
        young.update((u, old[u]) for u in missing if u in old)
        return [u for u in missing if u not in young]

    def trim(self, units: set[str]) -> None:
        """Drop the long ones of ``units``, and what two generations did not use."""
        for unit in [u for u in units if len(u) > LONGEST]:
            self.young.pop(unit, None)
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young

    def clear(self) -> None:
        self.young, self.old = {}, {}


def byte_of_character() -> dict[str, int]:
    """The byte behind each character of a vocabulary file: visible Latin-1 as it is, the others from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoding(path: str):
    """An encoding of ordinary text by the ranks of a tokenizer file.

    Its merges must be numbered as its tokens are, which makes a token's id its rank.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    plain = byte_of_character()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [model["vocab"][a + b] for a, b in pairs]
    if merged != sorted(merged):
        raise ValueError(f"the merges of {path} are not in the order of its ids")
    single = {c: i for c, i in model["vocab"].items() if len(c) == 1}
    ranks = {bytes([plain[c]]): i for c, i in single.items()}
    ranks |= {bytes(plain[c] for c in a + b): i for (a, b), i in zip(pairs, merged, strict=True)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def piece_encoder(path: str):
    """A function from ordinary text to its ids."""
    return encoding(path).encode_ordinary
