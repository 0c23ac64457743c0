"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

An id's rank by corpus frequency is written in 1 to 4 bytes; the lengths stand apart in control
bytes, four 2-bit lengths each.  Readers look a control byte up in a 256-row table for the four
lengths and gather the data bytes with numpy, without a loop over ids.

Layout of a store (a folder on any file system that Spark writes):

* ``codebook/``  ``rank int, id long, n long``: every id in use, most frequent first, ties by id.
* ``blocks/``    rows in ascending doc_id order, file after file; one row holds whole documents of
  about ``block_ids`` ids: ``part int`` (the file's number), ``start long`` (ids before it in the
  file), ``doc_ids array<long>``, ``doc_ids_n array<long>`` (ids per document), ``n long``,
  ``control binary``, ``data binary``.

Defined cases: a null or empty text holds the end id alone; a null doc_id sorts first; rows that
repeat a doc_id stand side by side, each as its own document; other columns are ignored; an empty
table gives an empty store and no rows.

At scale: one range shuffle of the 2-byte ids (not of the texts); the codebook is bounded by the
vocabulary and is the only thing broadcast; the per-file totals that give global starts are one
row for each output partition.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import Growing, binaries, cuts, discard, materialise, partitions, raw, shared_folder, ship
from fundlake.llm.distinct import DIGIT, GLUE, SPACE, Parts, classes, pieces

ENCODED = "doc_id long, ids binary"
BLOCKS = "part int, start long, doc_ids array<long>, doc_ids_n array<long>, n long, control binary, data binary"

# ---------------------------------------------------------------- the code

_CODES = np.arange(256, dtype=np.uint16)
#: Row c: the four lengths that control byte c stands for, lowest bits first.
LENGTHS = np.stack([(_CODES >> s) & 3 for s in (0, 2, 4, 6)], axis=1).astype(np.int64) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, dtype="<u4")
    lens = 1 + (v > 0xFF).astype(np.int64) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = lens - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    kept = np.arange(4) < lens[:, None]
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of ``pack``."""
    lens = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    at = np.cumsum(lens) - lens
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lens > k)
        out[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out & _MASKS[lens]


# ---------------------------------------------------------------- encoding texts

_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_WORD = re.compile(r"[a-zà-öø-ÿ]+")


@lru_cache(maxsize=2)
def word_encoder(path: str) -> Parts:
    """The ids of pieces.

    The tokenizer drops white space, lower-cases character by character and matches letters,
    single digits and symbol runs.  Latin words take a tokenizer of the same model without the
    normaliser, many at a time; other pieces the whole one.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    full = Tokenizer.from_file(path)
    full.encode_special_tokens = True
    bare = Tokenizer(full.model)
    bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    last = np.zeros(full.get_vocab_size(with_added_tokens=True), bool)
    for token, i in full.get_vocab(with_added_tokens=False).items():
        last[i] = token.endswith("</w>")

    def encode(pieces_: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        plain = [w for w in pieces_ if _WORD.fullmatch(w)]
        rest = [w for w in pieces_ if not _WORD.fullmatch(w)]
        text = [" ".join(plain[i : i + 2000]) for i in range(0, len(plain), 2000)]
        ids = [np.array(e.ids, np.uint32) for e in bare.encode_batch_fast(text, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends = np.flatnonzero(last[ids]) + 1
        if len(ends) != len(plain):  # never seen: a word that the model cut in two
            plain, rest, ids, ends = [], [*plain, *rest], ids[:0], ends[:0]
        others = [np.array(e.ids, np.uint32) for e in full.encode_batch_fast(rest, add_special_tokens=False)]
        lens = np.concatenate([np.diff(ends, prepend=0), np.array([len(x) for x in others], np.int64)])
        return [*plain, *rest], np.concatenate([ids, *others]), lens

    return Parts(encode, 500_000)


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, without white space and with ASCII letters in lower case, and their number in each text."""
    ends, data = raw(texts)
    c = classes(data)
    kept = c < SPACE
    starts = kept.copy()
    starts[1:] &= ~kept[:-1] | ((c[1:] != c[:-1]) & (c[1:] > GLUE) & (c[:-1] > GLUE)) | ((c[1:] == DIGIT) & (c[:-1] == DIGIT))
    first = ends[:-1][np.diff(ends) > 0]
    starts[first] = kept[first]
    where = np.flatnonzero(starts)
    before = np.cumsum(kept) - kept
    return pieces(_LOWER[data[kept]], before[where]), np.diff(np.searchsorted(where, ends))


def encode_column(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of an Arrow column of whole texts joined, and ids per text, without special tokens; null is empty."""
    return word_encoder(path).of_texts(*cut_words(texts))


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of whole texts, without special tokens."""
    flat, lens = encode_column(pa.array(texts, pa.string()), path)
    return np.split(flat, np.cumsum(lens)[:-1])


def encode(docs: DataFrame, tokenizer: str, end_id: int, wide: bool = False) -> DataFrame:
    """doc_id and the ids of the whole text with the end id, as little-endian 2-byte ids (4 if ``wide``)."""
    ship(docs.sparkSession)
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, n in cuts(b.column(1)):
                flat, lens = encode_column(b.column(1).slice(at, n), tokenizer)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, n), binaries(np.insert(flat.astype(kind), np.cumsum(lens), end_id), lens + 1)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


# ---------------------------------------------------------------- files

def write(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int = 2, block_ids: int = 1 << 17) -> None:
    """Encodes every document and writes the store at ``path``."""
    spark = docs.sparkSession
    wide = vocabulary > 1 << 16
    kind = "<u4" if wide else "<u2"
    encoded, temporary = materialise(encode(docs, tokenizer, end_id, wide), "ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(vocabulary, np.int64)
        for b in batches:
            n += np.bincount(raw(b.column(0))[1].view(kind), minlength=vocabulary)
        ids = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n[ids], pa.int64())], ["id", "n"])

    counts = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = sorted(((r.n, r.id) for r in counts.collect()), key=lambda x: (-x[0], x[1]))  # at most the vocabulary
    book = spark.createDataFrame([(k, i, n) for k, (n, i) in enumerate(found)], "rank int, id long, n long")
    book.coalesce(1).write.parquet(f"{path}/codebook")
    rank = np.zeros(vocabulary, np.uint32)
    rank[[i for _, i in found]] = np.arange(len(found), dtype=np.uint32)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start, held, docs_, sizes = TaskContext.get().partitionId(), 0, Growing(np.uint32), [], []

        def block():
            control, data = pack(held.data[: held.n])
            return pa.RecordBatch.from_pylist([{"part": part, "start": start, "doc_ids": docs_, "doc_ids_n": sizes, "n": held.n, "control": control, "data": data}], schema)

        schema = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_ids_n", pa.list_(pa.int64())), ("n", pa.int64()), ("control", pa.binary()), ("data", pa.binary())])
        for b in batches:
            for doc, x in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.frombuffer(x.as_buffer(), kind)
                held.extend(rank[ids])
                docs_.append(doc)
                sizes.append(len(ids))
                if held.n >= block_ids:
                    yield block()
                    start += held.n
                    held, docs_, sizes = Growing(np.uint32), [], []
        if docs_:
            yield block()

    n = partitions(spark)
    encoded.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids").mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    discard(spark, temporary)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian 4-byte) of every document."""
    ship(spark)
    stored = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    book = spark.read.parquet(f"{path}/codebook").orderBy("rank").collect()  # at most the vocabulary
    ids = np.array([r.id for r in book], np.uint32)
    totals = sorted((r.part, r.n) for r in stored.groupBy("part").agg(F.sum("n").alias("n")).collect())  # a row for each file
    first, total = {}, 0
    for part, n in totals:
        first[part], total = total, total + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                part, start, docs, sizes, n, control, data = (c[r].as_py() for c in b.columns)
                values = ids[unpack(control, data, n)].astype("<u4")
                ends = np.cumsum(sizes)
                rows = [values[e - k : e].tobytes() for e, k in zip(ends, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(first[part] + start + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return stored.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def store(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int = 2) -> str:
    """Writes a new store in the shared folder and returns its path."""
    path = f"{shared_folder(docs.sparkSession)}/fundlake/store-{uuid.uuid4().hex}"
    write(docs, path, tokenizer, vocabulary, end_id)
    return path


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what ``read`` gives."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
