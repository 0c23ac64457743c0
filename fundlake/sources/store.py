"""An incremental store of daily bars: Parquet by hash bucket, with a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.identifiers import bucket
from fundlake.operators.rows import keep_last

BUCKETS, OVERLAP = 64, 5


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only where that is unset and Spark runs in one process."""
    import tempfile

    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="fundlake-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def merge(stored: DataFrame | None, incoming: DataFrame, keys: tuple[str, ...] = ("isin", "date")) -> DataFrame:
    """Both sides' rows, the incoming one where a key is in both; of repeated incoming keys the last ``seq``."""
    new = keep_last(incoming if "seq" in incoming.columns else incoming.withColumn("seq", F.lit(0)), list(keys), ["seq", *[c for c in incoming.columns if c not in (*keys, "seq")]]).drop("seq")
    if stored is None:
        return new
    return stored.select(*new.columns).join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def upsert(spark: SparkSession, incoming: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Merges bars into the store: only the buckets that ``incoming`` touches are read and rewritten."""
    bad = incoming.where("isin IS NULL OR trim(isin) = '' OR date IS NULL").limit(1).count()
    if bad:
        raise ValueError("bars need an isin and a date")
    shared_folder(spark)
    rows = incoming.withColumn("bucket", bucket(F.col("isin"), buckets))
    if _exists(spark, path):
        stored = spark.read.parquet(path)
        touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
        merged = merge(stored.where(F.col("bucket").cast("int").isin(*touched)).withColumn("bucket", F.col("bucket").cast("short")), rows).checkpoint()  # read before its own files are replaced
    else:
        merged = merge(None, rows)
    merged.repartition("bucket").sortWithinPartitions("bucket", "isin", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("bucket").parquet(path)


def upsert_actions(spark: SparkSession, incoming: DataFrame, path: str) -> None:
    """Merges corporate actions into one table by isin, date and kind, the newest winning; it is read before it is replaced."""
    shared_folder(spark)
    stored = spark.read.parquet(path) if _exists(spark, path) else None
    merged = merge(stored, incoming, ("isin", "date", "kind")).checkpoint()
    merged.repartitionByRange("isin").sortWithinPartitions("isin", "date", "kind").write.mode("overwrite").option("compression", "zstd").parquet(path)


def rounds(spark: SparkSession, candidates: DataFrame, fetch, path: str, most: int) -> list[int]:
    """Asks every fund's first symbol, then the next one of funds that still have no bars, and so on; gives the numbers asked.

    ``fetch(candidates) -> bars``; bars go into the store at ``path`` round by round, so that a round that is lost
    costs only itself.
    """
    asked = []
    for rank in range(most):
        done = spark.read.parquet(path).select("isin") if _exists(spark, path) else spark.createDataFrame([], "isin string")
        todo = outstanding(candidates, done, rank)
        asked.append(todo.count())
        if not asked[-1]:
            break
        got = fetch(todo)
        if not got.isEmpty():
            upsert(spark, got, path)
    return asked


def read(spark: SparkSession, path: str, isins: list[str] | None = None, columns: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Bars; of some funds: only their buckets' folders are listed, and the isin filter reaches the scan."""
    df = spark.read.parquet(path)
    if isins is not None:
        keys = spark.createDataFrame([(i,) for i in isins], "isin string").select(bucket(F.col("isin"), buckets).alias("b")).distinct().collect() if isins else []
        df = df.where(F.col("bucket").cast("int").isin(*[k.b for k in keys])).where(F.col("isin").isin(*isins))
    return df.select(*columns) if columns else df.drop("bucket")


def manifest(bars: DataFrame, previous: DataFrame | None = None, tickers: DataFrame | None = None) -> DataFrame:
    """isin, first_date, last_date, bars, currency (of the last bar) and ticker, carried over unless given anew."""
    spans = bars.groupBy("isin").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("bars"), F.max_by("currency", "date").alias("currency"))
    for name, df in (("old", previous), ("new", tickers)):
        spans = spans.join(df.select("isin", F.col("ticker").alias(name)), "isin", "left") if df is not None else spans.withColumn(name, F.lit(None).cast("string"))
    return spans.withColumn("ticker", F.coalesce("new", "old")).drop("new", "old")


def refresh_requests(symbols: DataFrame, manifest_: DataFrame, inception: str, overlap: int = OVERLAP) -> DataFrame:
    """(symbol, start): the day to fetch from, ``overlap`` days before the earliest last bar of the symbol's funds; new funds from ``inception``."""
    per = symbols.join(manifest_.select("isin", "last_date"), "isin", "left").withColumn("start", F.coalesce(F.date_sub("last_date", overlap), F.lit(inception).cast("date")))
    return per.groupBy("symbol").agg(F.min("start").alias("start"))


def new_splits(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """isins with a split that the store does not hold: their history was restated."""
    pick = lambda d: d.where("kind = 'split'").select("isin", "date")
    return pick(incoming).join(pick(stored), ["isin", "date"], "left_anti").select("isin").distinct()


def replace_funds(bars: DataFrame, refetched: DataFrame) -> DataFrame:
    """``bars`` with the refetched funds' rows in place of theirs."""
    return bars.join(refetched.select("isin").distinct(), "isin", "left_anti").unionByName(refetched.select(*bars.columns))


def outstanding(candidates: DataFrame, done: DataFrame, rank: int) -> DataFrame:
    """The candidates of a rank whose fund has no bars yet."""
    return candidates.where(F.col("rank") == rank).join(done.select("isin").distinct(), "isin", "left_anti")
