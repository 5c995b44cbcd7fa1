"""Subword ids of whole texts from a public byte-level BPE vocabulary, with a cache of pieces.

The vocabulary's pattern cuts a text into pieces that are encoded one by one, so the ids of a piece never depend on
its neighbours and can be remembered. Texts made of plain characters are cut by a pattern that says the same for
them and runs faster; any other text goes to the tokenizer as a whole. Special strings that the caller names have ids
of their own wherever they stand in a text; without such names they are ordinary text.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import numpy as np
import tiktoken

#: Pieces remembered by a Python worker before the cache starts anew.
CACHED_PIECES = 200_000

LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
NOT_PLAIN = re.compile(rf"[^\t\n\r\x20-\x7e{LETTERS}]")
PLAIN_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
).findall


class Pieces(dict):
    """Piece -> ids, filled on demand."""

    def __init__(self, encoding: tiktoken.Encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= CACHED_PIECES:
            self.clear()
        ids = self[piece] = tuple(self.encoding.encode_ordinary(piece))
        return ids


class Subwords:
    """Ids of texts. ``special``: strings with an id of their own."""

    def __init__(self, ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = Pieces(self.encoding)
        self.special = dict(special)
        longest_first = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(longest_first)})").split if special else None

    def ids(self, text: str) -> np.ndarray:
        if any(name in text for name in self.special):
            parts = self.cut(text)
            return np.concatenate([np.uint32([self.special[p]]) if k % 2 else self.plain_ids(p) for k, p in enumerate(parts)])
        return self.plain_ids(text)

    def plain_ids(self, text: str) -> np.ndarray:
        if NOT_PLAIN.search(text):
            return np.asarray(self.encoding.encode_ordinary(text), np.uint32)
        return np.fromiter(chain.from_iterable(map(self.pieces.__getitem__, PLAIN_PIECES(text))), np.uint32)


LOADED: dict[tuple, Subwords] = {}


def subwords(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()) -> Subwords:
    """One tokenizer per Python worker, vocabulary and special strings."""
    key = ranks_path, pattern, special
    if key not in LOADED:
        LOADED[key] = Subwords(*key)
    return LOADED[key]
