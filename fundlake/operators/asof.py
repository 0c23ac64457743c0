"""As-of joins over published series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_validity(rates: DataFrame, by: str, value: str, days: int, forever: Column | None = None, horizon: Column | None = None) -> DataFrame:
    """``rates`` (by, date, value) as one row for each day a value holds: from its date to the day before the
    next one of its series, at most ``days`` days; series for which ``forever`` is true hold up to ``horizon``.

    The as-of join then is an equi-join on series and day.  The result has one row for each series and
    day, a bound that does not grow with the joined table.
    """
    nxt = F.lead("date").over(Window.partitionBy(by).orderBy("date"))
    capped = F.date_add("date", days)
    last = F.least(F.coalesce(F.date_sub(nxt, 1), capped), capped)
    if forever is not None:
        last = F.when(forever, F.greatest(F.coalesce(F.date_sub(nxt, 1), horizon), F.col("date"))).otherwise(last)
    spans = rates.where(F.col(value).isNotNull()).withColumn("upto_", last)
    return spans.select(by, F.explode(F.sequence("date", "upto_", F.expr("interval 1 day"))).alias("date"), value)


def asof_backward(left: DataFrame, right: DataFrame, by: str, on: str, values: list[str], strict: bool = False) -> DataFrame:
    """Each left row with ``values`` of the last right row of its ``by`` with ``on`` at or before its own (before, if
    ``strict``), by one union, one shuffle and one running window; any tolerance.
    """
    side = F.lit(1 if not strict else 0)
    a = left.select(*left.columns, F.lit(None).cast(right.schema[on].dataType).alias("found_"), *(F.lit(None).cast(right.schema[v].dataType).alias(v) for v in values), side.alias("side_"), F.lit(True).alias("own_"))
    b = right.select(*(F.lit(None).cast(left.schema[c].dataType).alias(c) if c not in (by, on) else F.col(c) for c in left.columns), F.col(on).alias("found_"), *values, F.lit(0 if not strict else 1).alias("side_"), F.lit(False).alias("own_"))
    w = Window.partitionBy(by).orderBy(on, "side_").rowsBetween(Window.unboundedPreceding, 0)
    row = F.last(F.when(~F.col("own_"), F.struct(F.col("found_"), *values)), ignorenulls=True).over(w)
    return a.unionByName(b).withColumn("row_", row).where("own_").select(*left.columns, F.col("row_.found_").alias("found_date"), *(F.col(f"row_.{v}").alias(v) for v in values))
