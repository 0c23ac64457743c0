"""Removal of 50-byte strings that an earlier document holds, by fingerprints of minimizers, runs and windows.

Texts are UTF-8 bytes.  A rank is a 64-bit hash that names the string of h bytes at a position; ranks
of 8, 16 and 32 bytes are paired at growing offsets, up to the threshold of 50.  Spark reranks the
positions three times, and each time those that are settled drop out:

1. Of each 50-byte window only its minimizer, the least 24-byte string in it, is ranked: equal windows
   have equal minimizers, so a minimizer that one document alone holds settles all its windows (about
   one position in 14 is sent, 5 bytes each).
2. The windows in a row that share a minimizer are one run of 50 to 76 bytes.  Runs are ranked whole;
   a run that an earlier document holds settles all its windows, and so does a minimizer in one run.
3. What is left, the rims of repeats, is ranked window by window.

Documents are kept in blocks of about 2 MB, written once, bucketed by block.  A block sends each rank
once with its smallest doc_id, packed by rank range (a copy, line or passage of any frequency is one
entry for each block, so no range is hot), and gets one code back for each; the answers join the blocks
without moving the texts.  Ranges grow in number with the corpus, so that one always fits a task; a
block's work grows with its own ranks, not with the ranges.

Defined cases: a null or empty text has no bytes; a null doc_id is neither earlier nor later than
any document and loses nothing; rows that repeat a doc_id are not earlier than each other; a text of
any length is hashed 2 MB at a time, its bytes and marks being held whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import partitions, shared_folder, ship, spans

LENGTH, SEED = 50, 24
SPAN = LENGTH - SEED + 1  # 24-byte strings in a window
BLOCK, CHUNK, RANGE = 2_000_000, 2_000_000, 32_000_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rank of two strings in a row, from their ranks."""
    h = a * _A + b * _B
    h ^= h >> np.uint64(32)
    h *= _C
    h ^= h >> np.uint64(29)
    return h


class Ranks:
    """Ranks of the strings at positions lo .. hi of a buffer."""

    def __init__(self, raw: np.ndarray, lo: int, hi: int):
        part = raw[lo : min(len(raw), hi + LENGTH + SPAN)]
        part = np.concatenate([part, np.zeros(LENGTH + 16, np.uint8)])
        n = len(part) - 8
        self.eight = np.ndarray((n,), "<u8", part, strides=(1,)).copy()
        self.sixteen = pair(self.eight[:-8], self.eight[8:])

    def window(self, at: np.ndarray) -> np.ndarray:
        """Ranks of the 50 bytes at ``at``: of 32 at it and of the 32 that end with it."""
        s = self.sixteen
        return pair(pair(s[at], s[at + 16]), pair(s[at + LENGTH - 32], s[at + LENGTH - 16]))

    def minimizers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For windows 0 .. n - 1 the place of their minimizer, and the ranks of the strings of 24 bytes."""
        seeds = pair(self.sixteen[: n + SPAN], self.eight[16 : 16 + n + SPAN])
        least = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(seeds), dtype=np.uint64)
        wide = 1
        while wide * 2 <= SPAN:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        least = np.minimum(least[: len(least) - (SPAN - wide)], least[SPAN - wide :])
        return (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64), seeds


class Runs:
    """The runs of a block: document, first and last window, ranks of minimizer and run."""

    def __init__(self, blob: bytes, sizes: np.ndarray, known: np.ndarray):
        raw = np.frombuffer(blob, np.uint8)
        ends = np.cumsum(sizes)
        self.raw, self.starts = raw, ends - sizes
        found = []
        for lo in range(0, len(raw), CHUNK):
            hi = min(len(raw), lo + CHUNK)
            doc = np.searchsorted(ends, np.arange(lo, hi), side="right")
            ok = np.flatnonzero((np.arange(lo, hi) + LENGTH <= ends[doc]) & known[doc])
            if not len(ok):
                continue
            ranks = Ranks(raw, lo, hi)
            place, seeds = ranks.minimizers(hi - lo)
            new = np.flatnonzero((np.diff(ok, prepend=-2) != 1) | (np.diff(place[ok], prepend=-1) != 0) | (np.diff(doc[ok], prepend=-1) != 0))
            first, last = ok[new], ok[np.append(new[1:], len(ok)) - 1]
            run = pair(pair(ranks.window(first), ranks.window(last)), (last - first).astype(np.uint64))
            # minimizers are small ranks: paired with a constant they are spread over all ranges alike
            found.append((doc[first], first + lo, last + lo, pair(seeds[place[first]], _C), run))
        names = ("doc", "first", "last", "seed", "run")
        for k, name in enumerate(names):
            setattr(self, name, np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64 if k > 2 else np.int64))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(run, place, rank) of every window of the runs ``which``."""
        sizes = self.last[which] - self.first[which] + 1
        at, of = spans(self.first[which], sizes), np.repeat(which, sizes)
        rank = np.zeros(len(at), np.uint64)
        for lo in range(0, len(self.raw), CHUNK):
            some = np.flatnonzero((at >= lo) & (at < lo + CHUNK))
            if len(some):
                rank[some] = Ranks(self.raw, lo, min(len(self.raw), lo + CHUNK)).window(at[some] - lo)
        return of, at, rank


def ranges(ranks: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(range, first, end) of each of the n ranges of equal width that sorted ``ranks`` have members in.

    By the upper half of a rank alone, in time that grows with the ranks and not with n.
    """
    of = ((ranks >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(of, prepend=~of[:1]))
    return list(zip(of[first].tolist(), first.tolist(), np.append(first[1:], len(of)).tolist()))


def least_by(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, index of each row's key, smallest id of each key)."""
    kinds, which = np.unique(keys, return_inverse=True)
    low = np.full(len(kinds), np.iinfo(np.int64).max)
    np.minimum.at(low, which, ids)
    return kinds, which, low


# ---------------------------------------------------------------- questions of a block, answers to it

def ask_seeds(runs: Runs, ids: np.ndarray, n: int):
    kinds, which, low = least_by(runs.seed, ids[runs.doc])
    many = np.zeros(len(kinds), bool)
    many[which[ids[runs.doc] != low[which]]] = True
    low_bytes = np.ascontiguousarray(kinds.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5]
    for k, a, b in ranges(kinds, n):  # the lower five bytes: they say nothing that the range says
        yield k, low_bytes[a:b].tobytes() + np.packbits(many[a:b]).tobytes()


def settle_seeds(payloads: list[bytes]) -> list[bytes]:
    """For each payload a bit for each seed: held by several documents."""
    keys, many, sizes = [], [], []
    for p in payloads:
        n = len(p) * 8 // 41
        while 5 * n + -(-n // 8) < len(p):
            n += 1
        raw = np.zeros((n, 8), np.uint8)
        raw[:, :5] = np.frombuffer(p, np.uint8, 5 * n).reshape(-1, 5)
        keys.append(raw.view("<u8").ravel())
        many.append(np.unpackbits(np.frombuffer(p, np.uint8, offset=5 * n), count=n).astype(bool))
        sizes.append(n)
    kinds, which = np.unique(np.concatenate(keys), return_inverse=True)
    several = np.bincount(which, minlength=len(kinds)) > 1
    several[which[np.concatenate(many)]] = True
    return [np.packbits(x).tobytes() for x in np.split(several[which], np.cumsum(sizes)[:-1])]


def live_runs(runs: Runs, ids: np.ndarray, several: np.ndarray):
    """(indices of runs with a shared minimizer, distinct runs in order of minimizer, index of each, its smallest id)."""
    kinds, which = np.unique(runs.seed, return_inverse=True)
    live = np.flatnonzero(several[which]) if len(kinds) else np.zeros(0, np.int64)
    both = np.stack([runs.seed[live], runs.run[live]], axis=1) if len(live) else np.zeros((0, 2), np.uint64)
    order = np.lexsort((both[:, 1], both[:, 0]))
    new = np.ones(len(live), bool)
    new[1:] = (both[order][1:] != both[order][:-1]).any(axis=1)
    which = np.empty(len(live), np.int64)
    which[order] = np.cumsum(new) - 1
    kinds = both[order][new]
    low = np.full(len(kinds), np.iinfo(np.int64).max)
    np.minimum.at(low, which, ids[runs.doc[live]])
    return live, kinds, which, low


def ask_runs(kinds: np.ndarray, low: np.ndarray, n: int):
    rows = np.concatenate([kinds, low.view(np.uint64)[:, None]], axis=1).astype("<u8")
    for k, a, b in ranges(kinds[:, 0], n):
        yield k, rows[a:b].tobytes()


def settle_runs(payloads: list[bytes]) -> list[bytes]:
    """For each run of each payload: 1 an earlier document holds it, 2 first but its minimizer has other runs, else 0."""
    rows = [np.frombuffer(p, "<u8").reshape(-1, 3) for p in payloads]
    all_ = np.concatenate(rows)
    seed, run, low = all_[:, 0], all_[:, 1], all_[:, 2].view(np.int64)
    _, which, first = least_by(run, low)
    kinds, of = np.unique(seed, return_inverse=True)
    least, most = np.full(len(kinds), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(kinds), np.uint64)
    np.minimum.at(least, of, run)
    np.maximum.at(most, of, run)
    code = np.where(first[which] < low, 1, np.where((least != most)[of], 2, 0)).astype(np.uint8)
    return [x.tobytes() for x in np.split(code, np.cumsum([len(r) for r in rows])[:-1])]


def ask_windows(kinds: np.ndarray, low: np.ndarray, n: int):
    rows = np.stack([kinds, low.view(np.uint64)], axis=1).astype("<u8")
    for k, a, b in ranges(kinds, n):
        yield k, rows[a:b].tobytes()


def settle_windows(payloads: list[bytes]) -> list[bytes]:
    """For each window of each payload: 1 if an earlier document holds it."""
    rows = [np.frombuffer(p, "<u8").reshape(-1, 2) for p in payloads]
    all_ = np.concatenate(rows)
    low = all_[:, 1].view(np.int64)
    _, which, first = least_by(all_[:, 0], low)
    return [x.tobytes() for x in np.split((first[which] < low).astype(np.uint8), np.cumsum([len(r) for r in rows])[:-1])]


class Block:
    """A block with the answers so far."""

    def __init__(self, n_ranges: int, ids: list, sizes: list, blob: bytes, seeds, runs, windows):
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.runs = Runs(blob, np.array(sizes, np.int64), self.known)
        if seeds is None:
            return
        kinds = np.unique(self.runs.seed)
        several, codes = np.zeros(len(kinds), bool), dict(seeds)
        for k, a, b in ranges(kinds, n_ranges):
            several[a:b] = np.unpackbits(np.frombuffer(codes[k], np.uint8), count=b - a)
        self.live, self.kinds, self.which, self.low = live_runs(self.runs, self.ids, several)
        if runs is None:
            return
        code = np.frombuffer(b"".join(c for _, c in sorted(runs)), np.uint8)
        mine = self.ids[self.runs.doc[self.live]]
        self.covered = self.live[(code[self.which] == 1) | (mine > self.low[self.which])]
        rim = self.live[(code[self.which] == 2) & (mine == self.low[self.which])]
        self.of, self.at, rank = self.runs.windows(rim)
        self.wkinds, self.wwhich, self.wlow = least_by(rank, self.ids[self.runs.doc[self.of]])
        if windows is None:
            return
        code = np.frombuffer(b"".join(c for _, c in sorted(windows)), np.uint8).astype(bool)
        hit = code[self.wwhich] | (self.ids[self.runs.doc[self.of]] > self.wlow[self.wwhich])
        self.hits = self.at[hit]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row, and the removed spans as (first, end) byte arrays."""
    spark = docs.sparkSession
    ship(spark)
    n = partitions(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, sizes, parts, held = TaskContext.get().partitionId() << 32, [], [], [], 0
        schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("total", pa.int64()), ("blob", pa.binary())])
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = text.as_buffer() if text.is_valid else b""
                ids.append(doc)
                sizes.append(len(raw))
                parts.append(raw)
                held += len(raw)
                if held >= BLOCK:
                    yield pa.RecordBatch.from_pylist([{"block": number, "ids": ids, "sizes": sizes, "total": held, "blob": b"".join(parts)}], schema)
                    number, ids, sizes, parts, held = number + 1, [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([{"block": number, "ids": ids, "sizes": sizes, "total": held, "blob": b"".join(parts)}], schema)

    name = f"fundlake_blocks_{uuid.uuid4().hex}"
    packed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pack, "block long, ids array<long>, sizes array<long>, total long, blob binary")
    packed.repartition(n, "block").write.format("parquet").option("compression", "zstd").option("path", f"{shared_folder(spark)}/fundlake/{name}").bucketBy(n, "block").saveAsTable(name)
    blocks = spark.table(name)
    total = blocks.agg(F.sum("total")).first()[0] or 0
    n_ranges = int(max(n, total // RANGE))

    def asked(step: int, joined: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in range(b.num_rows):
                    block = load(b, r)
                    rows = list(ask_seeds(block.runs, block.ids, n_ranges) if step == 0 else ask_runs(block.kinds, block.low, n_ranges) if step == 1 else ask_windows(block.wkinds, block.wlow, n_ranges))
                    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([b.column(0)[r].as_py()] * len(rows), pa.int64()), pa.array([p for _, p in rows], pa.binary())], ["span", "block", "payload"])

        return joined.mapInArrow(run, "span int, block long, payload binary")

    def load(b: pa.RecordBatch, r: int) -> Block:
        get = lambda c: b.column(c)[r].as_py() if c in b.schema.names else None
        answers = [None if a not in b.schema.names else [(x["span"], x["code"]) for x in get(a) or []] for a in ("a0", "a1", "a2")]
        return Block(n_ranges, get("ids"), get("sizes"), get("blob"), *answers)

    def answered(step: int, questions: DataFrame) -> DataFrame:
        settle = (settle_seeds, settle_runs, settle_windows)[step]

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"span": rows["span"], "block": rows["block"], "code": settle(rows["payload"].tolist())})

        out = questions.groupBy("span").applyInPandas(run, "span int, block long, code binary")
        return out.groupBy("block").agg(F.collect_list(F.struct("span", "code")).alias(f"a{step}"))

    joined = blocks.drop("total")
    for step in range(3):
        path = f"{shared_folder(spark)}/fundlake/answers-{uuid.uuid4().hex}"
        answers = answered(step, asked(step, joined))
        answers.write.option("compression", "zstd").parquet(path)
        joined = joined.join(spark.read.schema(answers.schema).parquet(path).hint("shuffle_hash"), "block", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                ids, sizes = b.column("ids")[r].as_py(), np.array(b.column("sizes")[r].as_py(), np.int64)
                block, blob = load(b, r), b.column("blob")[r].as_py()
                runs = block.runs
                cover = np.zeros(len(blob) + LENGTH + 1, np.int32)
                np.add.at(cover, runs.first[block.covered], 1)
                np.add.at(cover, runs.last[block.covered] + LENGTH, -1)
                np.add.at(cover, block.hits, 1)
                np.add.at(cover, block.hits + LENGTH, -1)
                gone = np.cumsum(cover)[: len(blob)] > 0
                raw, rows, at = np.frombuffer(blob, np.uint8), [], 0
                for doc, size in zip(ids, sizes.tolist()):
                    g = np.concatenate([[False], gone[at : at + size], [False]])
                    edges = np.flatnonzero(g[1:] != g[:-1])
                    kept = raw[at : at + size][~g[1:-1]]
                    rows.append((doc, size, size - len(kept), len(edges) // 2, hashlib.sha256(kept).hexdigest(), edges[::2].tolist(), edges[1::2].tolist()))
                    at += size
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], kind) for k, kind in enumerate(kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "first", "end"])

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, first array<long>, end array<long>")
