"""Byte-level BPE over Arrow batches, by the ranks of a tiktoken file, and its inverse.

The model is built for the tokenizers library from the ranks: every byte is written as a printable
character (the byte table), and every way to split a token into two tokens becomes a merge of that
token's rank, so any adjacent pair whose join is a token may merge, lowest rank first.

Each match of the pre-tokenizing pattern is encoded separately.  Texts are cut where a match always
ends, and a worker asks the library once for each distinct piece (see ``distinct``).

``encode`` gives ids and, on request, each token's character offsets, as the library gives them: byte
lengths of the tokens are summed and mapped through the byte-to-character table of the text; a token
that holds only part of a character spans that whole character.  ``decode`` turns the characters of each
token back into bytes by the reversed byte table and joins bytes before it decodes them, so characters split
over tokens come back whole.

Defined cases: a null or empty text has no ids; a null doc_id is kept; repeated rows are encoded
each; other columns are ignored; an empty table gives no rows.  At scale: one narrow pass, no
shuffle, nothing broadcast; a worker holds its pieces (a bounded number) and the texts it works on: 4 MB, or one
longer text, at about 40 bytes for each of its bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import cuts, raw, ship
from fundlake.llm.distinct import BLANK, GLUE, LETTER, SPACE, SYMBOL, Parts, classes, pieces

_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Cuts between two known characters: white space after a word, a word after a line feed or a tab, a change of class.
_BETWEEN = np.zeros((6, 6), bool)
_BETWEEN[LETTER : SYMBOL + 1, LETTER:] = ~np.eye(3, 5, dtype=bool)
_BETWEEN[BLANK, LETTER : SYMBOL + 1] = True


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else one from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


def cut_matches(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All texts cut into pieces of whole matches, and the number of pieces of each."""
    ends, data = raw(texts)
    c = classes(data)
    starts = np.zeros(len(c), bool)
    starts[1:] = _BETWEEN[c[:-1], c[1:]]
    # the last white space before a word never belongs to the match before it
    before_word = np.zeros(len(c), bool)
    before_word[:-1] = (c[1:] > GLUE) & (c[1:] < SPACE)
    before_word[ends[1:][np.diff(ends) > 0] - 1] = False
    starts |= (c >= SPACE) & before_word
    starts[ends[:-1][np.diff(ends) > 0]] = True
    where = np.flatnonzero(starts)
    return pieces(data, where), np.diff(np.searchsorted(where, ends))


class ByteBpe:
    """The codec of one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks, chars = read_ranks(path), byte_characters()
        seen = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
        merges = [(r, t[:i], t[i:]) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        merges.sort(key=lambda m: (m[0], len(m[1])))
        model = models.BPE(vocab={seen[t]: r for t, r in ranks.items()}, merges=[(seen[a], seen[b]) for _, a, b in merges])
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.full, self.words = Tokenizer(model), Tokenizer(model)
        self.full.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), as_bytes])
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), as_bytes])
        # the byte table reversed: a token's characters, as the library's vocabulary has them, back to bytes
        byte = {c: b for b, c in enumerate(chars)}
        tokens = self.full.get_vocab()
        self.bytes: list[bytes] = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.bytes[i] = bytes(map(byte.__getitem__, token))
        self.sizes = np.array([len(t) for t in self.bytes], np.int64)
        self.decimal = [b"%d " % i for i in range(len(self.bytes))]
        self.parts = Parts(self._encode, 400_000)

    def _encode(self, pieces_: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Words many at a time, told apart again by their lengths in bytes; other pieces one by one."""
        plain = [p for p in pieces_ if _WORD.fullmatch(p)]
        rest = [p for p in pieces_ if not _WORD.fullmatch(p)]
        ids, lens = [], []
        groups = [plain[k : k + 2000] for k in range(0, len(plain), 2000)]
        for some, e in zip(groups, self.words.encode_batch_fast(["\n".join(some) for some in groups], add_special_tokens=False)):
            ids.append(np.array(e.ids, np.uint32))
            lens.append(np.diff(np.searchsorted(np.cumsum(self.sizes[ids[-1]]), np.cumsum([len(p.encode()) for p in some])) + 1, prepend=0))
        for e in self.full.encode_batch_fast(rest, add_special_tokens=False):
            ids.append(np.array(e.ids, np.uint32))
            lens.append([len(ids[-1])])
        return [*plain, *rest], np.concatenate(ids), np.concatenate(lens).astype(np.int64)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow column of texts joined, and ids per text; null is empty."""
        return self.parts.of_texts(*cut_matches(texts))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, lens = self.encode_column(pa.array(texts, pa.string()))
        return np.split(flat, np.cumsum(lens)[:-1])

    def offsets(self, texts: pa.Array, ids: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end character, in its own text, of each of the texts' ids: a token that holds part of a character spans it."""
        ends, data = raw(texts)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        upto = np.cumsum(self.sizes[ids])
        start = np.repeat(np.append(character, 0)[np.minimum(ends[:-1], max(len(data) - 1, 0))], lens)
        return character[upto - self.sizes[ids]] - start, character[upto - 1] + 1 - start

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids) -> str:
        """Text of ids; bytes that form no character (a cut sequence of ids) become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """doc_id, ids array<int> and, with ``offsets``, first and end characters of every token."""
    ship(docs.sparkSession)
    kind = "doc_id long, ids array<int>" + ", first array<int>, ends array<int>" * offsets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, names = codec(path, pattern), ["doc_id", "ids", "first", "ends"][: 2 + 2 * offsets]
        for b in batches:
            for at, n in cuts(b.column(1)):
                texts = b.column(1).slice(at, n)
                ids, lens = bpe.encode_column(texts)
                bounds = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
                columns = [ids, *(bpe.offsets(texts, ids, lens) if offsets else ())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, n), *(pa.ListArray.from_arrays(bounds, pa.array(c.astype(np.int32))) for c in columns)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kind)


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes and text of doc_id, ids; null ids decode to nothing."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for b in batches:
            raw = [bpe.decode_bytes(x or ()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in raw])], ["doc_id", "bytes", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256 (the bytes that the ids give),
    n_split (tokens that start or end inside a character) and last_char (where the last token ends, in characters)."""
    ship(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split", "last_char"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for b in batches:
            for at, n in cuts(b.column(1)):
                texts = b.column(1).slice(at, n)
                flat, lens = bpe.encode_column(texts)
                ends = np.cumsum(lens)
                ids = [x.tolist() for x in np.split(flat, ends[:-1])]
                said = [hashlib.sha256(b"".join(map(bpe.decimal.__getitem__, x))[:-1]).hexdigest() for x in ids]
                back = [hashlib.sha256(bpe.decode_bytes(x)).hexdigest() for x in ids]
                first, end = bpe.offsets(texts, flat, lens)
                overlap = np.zeros(len(flat) + 1, np.int64)  # a token that starts before the end of the one before it shares a character
                overlap[1:-1] = first[1:] < end[:-1]
                overlap[ends[lens > 0] - lens[lens > 0]] = 0
                split = np.concatenate([[0], np.cumsum((overlap[:-1] | overlap[1:]) > 0)])
                last = np.where(lens > 0, np.append(end, 0)[np.maximum(ends - 1, 0)], 0)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, n), pa.array(lens), pa.array(said), pa.array(back), pa.array(split[ends] - split[ends - lens]), pa.array(last)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long, last_char long")
