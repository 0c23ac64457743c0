"""What the corpus operators share: reading tables, shared intermediate tables, growing arrays."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package when the driver runs from another folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    env.setdefault("OMP_NUM_THREADS", "1")
    env.setdefault("RAYON_NUM_THREADS", "1")
    env.setdefault("TOKENIZERS_PARALLELISM", "false")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only where that is unset and Spark runs in one process."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="fundlake-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


_made: list[str] = []


def materialise(df: DataFrame, tag: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """Writes ``df`` to the shared folder and reads it back: a lost executor costs no earlier work.

    The table stays until ``discard`` or ``release``: what an operator returns may read it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/fundlake/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes intermediate tables that nothing reads any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        if path in _made:
            _made.remove(path)


def release(spark: SparkSession) -> None:
    """Removes every intermediate table that is left; for a caller that has written what its operators returned."""
    discard(spark, *_made)


def plain_names(df: DataFrame, *without: str) -> tuple[DataFrame, list[str]]:
    """``df`` without some columns, the others named c0, c1, ... so that no working column can clash; their own names."""
    own = [c for c in df.columns if c not in without]
    return df.drop(*without).toDF(*(f"c{i}" for i in range(len(own)))), own


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id"):
    """True for rows whose crc32 of the id as text is divisible by 5; null ids are never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Growing:
    """A numpy array that is appended to in amortised constant time."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1024, dtype), 0

    def extend(self, values) -> None:
        k = len(values)
        if self.n + k > len(self.data):
            self.data = np.resize(self.data, max(2 * len(self.data), self.n + k))
        self.data[self.n : self.n + k] = values
        self.n += k


def spans(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + lens[i] - 1 of every i, one after the other."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def cuts(column, most: int = 4_000_000):
    """(first, number) of runs of rows of an Arrow string or binary column with about ``most`` bytes each."""
    import pyarrow.compute as pc

    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))
    at = 0
    while at < len(column):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield at, to - at
        at = to


def slices(column, most: int = 4_000_000):
    """(first, texts) of runs of rows of an Arrow string column with about ``most`` bytes each; null is empty."""
    for at, n in cuts(column, most):
        yield at, [x or "" for x in column.slice(at, n).to_pylist()]


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """(ends of the rows from 0 on, all bytes) of an Arrow string or binary column without copying; null is empty."""
    import pyarrow as pa

    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return ends - ends[0], held[ends[0] : ends[-1]]


def binaries(values: np.ndarray, counts: np.ndarray):
    """An Arrow binary column of ``values`` dealt out to rows of ``counts`` values each."""
    import pyarrow as pa

    ends = np.concatenate([[0], np.cumsum(counts) * values.itemsize]).astype(np.int64)
    wide = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])
    return wide.cast(pa.binary())
