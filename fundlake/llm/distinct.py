"""Encoding by distinct pieces: a text's ids are the ids of its pieces in turn, so that Arrow numbers the
distinct pieces of a slice of texts, each is looked up once, only those that no earlier slice had go to the
tokenizers library, and numpy lays the ids out in the order of the text.

Cuts are made by character class where the tokenizer's own pre-tokenizer always ends a match, whatever
stands around, so the result equals encoding the whole text.  Classes are known for ASCII letters, digits,
symbols and white space and for the Latin letters U+00C0 to U+00FF; at every other character (``GLUE``), and
at apostrophes, which may start a contraction, no cut is made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from fundlake.llm.common import Growing, spans

GLUE, LETTER, DIGIT, SYMBOL, SPACE, BLANK = range(6)
_CLASS = np.zeros(256, np.uint8)
for _b in range(0x21, 0x7F):
    _CLASS[_b] = LETTER if chr(_b).isalpha() else DIGIT if chr(_b).isdigit() else SYMBOL
_CLASS[list(b"\t\n\v\f\r")] = BLANK
_CLASS[ord(" ")] = SPACE
_CLASS[ord("'")] = GLUE


def classes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 text belongs to."""
    out = _CLASS[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # × and ÷ are no letters
    out[lead] = out[lead + 1] = LETTER
    return out


def pieces(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """``data`` cut at ``starts``, the first of which is 0."""
    bounds = np.append(starts, len(data)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(np.ascontiguousarray(data))])


class Parts:
    """Ids of pieces, looked up or learnt.

    ``encode(pieces)`` gives (the pieces in the order it likes, their ids joined, ids per piece).
    ``limit`` bounds the pieces held; beyond it only those of the slice at hand are kept.
    """

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit
        self._hold([], np.zeros(0, np.uint32), np.zeros(0, np.int64), anew=True)

    def _hold(self, keys: list[str], flat: np.ndarray, lens: np.ndarray, anew: bool = False) -> None:
        if anew:
            self.index: dict[str, int] = {}
            self.flat, self.start, self.len = Growing(np.uint32), Growing(np.int64), Growing(np.int64)
        n = len(self.index)
        self.start.extend(self.flat.n + np.cumsum(lens) - lens)
        self.len.extend(lens)
        self.flat.extend(flat)
        self.index.update(zip(keys, range(n, n + len(keys))))

    def _look_up(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))
        lens = self.len.data[at]
        return self.flat.data[spans(self.start.data[at], lens)], lens

    def ids(self, pieces_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct ``pieces_`` joined, and the number of each one's ids."""
        missing = [p for p in pieces_ if p not in self.index]
        if missing:
            if len(self.index) + len(missing) > self.limit:
                known = [p for p in pieces_ if p in self.index]
                self._hold(known, *self._look_up(known), anew=True)
            self._hold(*self.encode(missing))
        return self._look_up(pieces_)

    def of_texts(self, pieces_: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, and the number of each text's ids; ``counts``: pieces of each text."""
        coded = pieces_.dictionary_encode()
        flat, lens = self.ids(coded.dictionary.cast(pa.string()).to_numpy(zero_copy_only=False).tolist())
        at = coded.indices.to_numpy()
        each = lens[at]
        ends = np.concatenate([[0], np.cumsum(each)])
        return flat[spans((np.cumsum(lens) - lens)[at], each)], np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])
