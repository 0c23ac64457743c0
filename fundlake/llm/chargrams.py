"""Hashed character n-grams of many texts at once, as numpy arrays.

Letters count in lower case and everything else as a space, so n-grams see word starts and ends.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np

SPACE = 32


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """For every code point its lower-case letter, or a space if it is no letter."""
    to = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for c in range(sys.maxunicode + 1):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            to[c] = ord(low) if len(low) == 1 else c
    return to


def has_letter(text: str | None) -> bool:
    return bool(text) and any(unicodedata.category(c)[0] == "L" for c in set(text))


def codes(texts: list[str], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(folded code points of all texts with ``longest`` spaces after each, start of each text)."""
    pad = "\n" * longest
    raw = np.frombuffer((pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.array([len(t) + longest for t in texts], np.int64)
    return folding()[raw], np.cumsum(lens) - lens


def segments(texts: list[str], longest: int, span: int = 1_500_000):
    """Lists of (number of the text, piece, positions that count) with about ``span`` characters.

    A longer text is cut: each piece but the last also holds the characters that its last n-grams reach
    into, so that the n-grams of all pieces are those of the text, in bounded memory.  What counts of a
    text are its characters and one space: n-grams from there on would reach into the next text.
    """
    run, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t), 1), span):
            last = at + span >= len(t)
            piece = t[at : at + span + (0 if last else longest - 1)]
            run.append((i, piece, len(piece) + 1 if last else span))
            size += len(piece)
            if size >= span:
                yield run
                run, size = [], 0
    if run:
        yield run


def grams(c: np.ndarray, orders: tuple[int, ...], bits: int):
    """For each order in turn the bucket of the n-gram that starts at each position.

    The last positions, too near the end for an n-gram, take what spaces would give: they are padding.
    """
    h = np.zeros(len(c), np.uint32)
    for k in range(1, max(orders) + 1):
        nxt = np.full(len(c), SPACE, np.uint32)
        nxt[: len(c) - k + 1] = c[k - 1 :]
        h = (h ^ nxt) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if k in orders:
            yield k, ((h + np.uint32(k)) * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)
