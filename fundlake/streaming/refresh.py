"""The store fed by a stream: every micro-batch is merged, so late and corrected bars heal it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundlake.sources import store


def follow(spark: SparkSession, bars: DataFrame, path: str, checkpoint: str, buckets: int = store.BUCKETS):
    """Merges a stream of bars into the store at ``path`` until nothing more is there, and returns the finished query.

    No watermark: a late bar is never dropped.  A batch that is replayed after a failure gives the same
    rows, because newest wins by key.
    """

    def batch(df: DataFrame, _: int) -> None:
        if not df.isEmpty():
            store.upsert(df.sparkSession, df, path, buckets)

    query = bars.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
