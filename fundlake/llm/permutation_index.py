"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``prefix`` nearest of ``pivots`` pivots in order.  The index is written
once, in blocks of ``block`` vectors; in a block every pivot has its inverted file: the place that the
pivot has in the prefix of each vector, ``prefix`` where it is not in it.  As half of all pivots are in a
prefix, files are dense rows of one byte for each vector, vectors numbered by position.

A query opens the files of its ``probes`` nearest pivots alone and adds up the differences of places: the
footrule distance of the two orders, over the pivots that are nearest to the query.  Of the whole
index the ``effort`` * sqrt(n) vectors nearest by footrule, at least ``k``, are reranked by exact distance
in double precision: one rule for every n.  Blocks are dealt by a hash, so each block reranks its
part of them, and three standard deviations more.

Pivots are a bounded sample, the vectors with the smallest hashes of vec_id; every vector is posted.
Index blocks stay put; blocks of queries, about 1 KB a query, are sent to every index block (a block is also
copied, at most twice for each core in all, where there are fewer blocks than cores).  A query thus
reads a byte for each vector and probed pivot, and about sqrt(n) vectors.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components take no part, nor do
those of another length than most have (of equally many the shorter: no distance is defined between lengths); a
null vec_id takes no part; rows that repeat a vec_id are vectors of their own, each other's candidates and each
a query (``copy`` numbers them); ties in distance go to the smaller vec_id, then copy, ties in footrule at the edge
of what is reranked to the smaller vec_id, then copy; with fewer candidates than k all are given; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import materialise, ship
from fundlake.llm.sampling import by_hash


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, copy and v of the vectors that can take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v"), fine.alias("fine")).where("vec_id is not null and v is not null and size(v) > 0 and fine")
    return rows.select("vec_id", F.row_number().over(Window.partitionBy("vec_id").orderBy("v")).alias("copy"), "v")


def orders(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of all pivots by distance from each vector, nearest first, ties to the smaller number."""
    d = (pivots**2).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.argsort(d, axis=1, kind="stable")


def inverted(order: np.ndarray, prefix: int) -> np.ndarray:
    """Row p: the place of pivot p in each vector's order, ``prefix`` from there on."""
    n, p = order.shape
    files = np.full((p, n), prefix, np.uint8)
    for place in range(min(prefix, p)):
        files[order[:, place], np.arange(n)] = place
    return files


def footrule(files: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """For every vector the sum of |its place - the query's| over the query's pivots ``probes``."""
    total = np.zeros(files.shape[1], np.uint32)
    for place, p in enumerate(probes):
        at = np.uint8(place)
        total += np.maximum(files[p], at) - np.minimum(files[p], at)
    return total


def build(vectors: DataFrame, pivots: int = 512, prefix: int = 255, block: int = 16384) -> tuple[DataFrame, np.ndarray]:
    """(the written index: block, n, ids, copies, data, files; the pivots); ``prefix`` is 255 at most."""
    spark = vectors.sparkSession
    ship(spark)
    rows, _ = materialise(usable(vectors), "vectors")
    usual = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    dims, total = (usual.dims, usual.n) if usual else (0, 0)
    rows = rows.where(F.size("v") == dims)
    chosen = sorted((r.vec_id, r.copy, r.v) for r in by_hash(rows, pivots, "vec_id").collect())
    table = np.array([v for _, _, v in chosen], float).reshape(len(chosen), dims)
    n_blocks = max(1, -(-total // block))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                held = sorted((x["vec_id"], x["copy"], x["v"]) for x in b.column(1)[r].as_py())
                x = np.array([v for _, _, v in held])
                columns = [pa.array([total], pa.int64()), pa.array([[i for i, _, _ in held]], pa.list_(pa.int64())), pa.array([[c for _, c, _ in held]], pa.list_(pa.int32()))]
                files = inverted(orders(x, table), prefix)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(r, 1), *columns, pa.array([x.tobytes()], pa.binary()), pa.array([files.tobytes()], pa.binary())], ["block", "n", "ids", "copies", "data", "files"])

    grouped = rows.groupBy(F.pmod(F.xxhash64("vec_id", "copy"), F.lit(n_blocks)).cast("long").alias("block")).agg(F.collect_list(F.struct("vec_id", "copy", "v")).alias("held"))
    index, _ = materialise(grouped.mapInArrow(post, "block long, n long, ids array<long>, copies array<int>, data binary, files binary"), "index")
    return index, table


def search(index: DataFrame, pivots: np.ndarray, queries, k: int = 10, probes: int = 64, effort: float = 8.0, query_block: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score, copy (of the query), found_copy and reranked (vectors whose distance was taken) of
    the k nearest found of each indexed vector that ``queries`` (a condition on vec_id) picks."""
    spark, dims = index.sparkSession, pivots.shape[1]
    keys = ["query_id", "copy", "data", "probes"]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                ids, copies, data, wanted = (c[r].as_py() for c in b.columns)
                at = np.flatnonzero(np.isin(np.array(ids, np.int64), np.array(wanted or [], np.int64)))
                x = np.frombuffer(data, float).reshape(len(ids), dims)[at]
                if len(x):
                    near = orders(x, pivots)[:, :probes].astype(np.uint16)
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in at], pa.int64()), pa.array([copies[i] for i in at], pa.int32()), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([o.tobytes() for o in near], pa.binary())], keys)

    wanted = index.select("ids", "copies", "data", F.filter("ids", queries).alias("wanted")).mapInArrow(pick, "query_id long, copy int, data binary, probes binary")
    wanted, _ = materialise(wanted, "queries")
    n_query, n_index = max(1, -(-wanted.count() // query_block)), int(index.agg(F.max("block")).first()[0] or 0) + 1
    spread = min(n_query, max(1, 2 * spark.sparkContext.defaultParallelism // n_index))
    asked = wanted.groupBy(F.pmod(F.xxhash64("query_id", "copy"), F.lit(n_query)).cast("long").alias("q")).agg(F.collect_list(F.struct(*keys)).alias("asked"))
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(n_index - 1)).cast("array<long>")).alias("block"), F.pmod("q", F.lit(spread)).alias("part"), "asked")
    blocks = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)).cast("array<long>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                n = b.column(0)[r].as_py()
                ids, copies = (np.array(b.column(i)[r].as_py(), np.int64) for i in (1, 2))
                x = np.frombuffer(b.column(3)[r].as_buffer(), float).reshape(len(ids), dims)
                files = np.frombuffer(b.column(4)[r].as_buffer(), np.uint8).reshape(len(pivots), len(ids))
                part = max(k, effort * np.sqrt(n)) * len(ids) / n
                size = min(len(ids), int(np.ceil(part + 3 * np.sqrt(part))) + 1)  # one for the query itself
                found = []
                for q in b.column(5)[r].as_py():
                    far = footrule(files, np.frombuffer(q["probes"], np.uint16))
                    edge = np.partition(far, size - 1)[size - 1]
                    # rows lie in the order of vec_id and copy
                    take = np.concatenate([np.flatnonzero(far < edge), np.flatnonzero(far == edge)])[:size]
                    take = take[(ids[take] != q["query_id"]) | (copies[take] != q["copy"])]
                    d = np.sqrt(((x[take] - np.frombuffer(q["data"], float)) ** 2).sum(axis=1))
                    best = np.lexsort((copies[take], ids[take], d))[:k]
                    found.append((np.full(len(best), q["query_id"]), np.full(len(best), q["copy"]), ids[take][best], copies[take][best], d[best], np.full(len(best), len(take))))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found])) for i in range(6)], ["query_id", "copy", "vec_id", "found_copy", "score", "reranked"])

    hits = blocks.join(asked, ["block", "part"]).select("n", "ids", "copies", "data", "files", "asked").mapInArrow(run, "query_id long, copy long, vec_id long, found_copy long, score double, reranked long")
    place = F.row_number().over(Window.partitionBy("query_id", "copy").orderBy("score", "vec_id", "found_copy"))
    return hits.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "copy", "found_copy", "reranked")
