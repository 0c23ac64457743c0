"""Chart payloads: JSON to bars and corporate actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYLOAD = (
    "chart struct<result:array<struct<meta:struct<currency:string,exchangeTimezoneName:string,gmtoffset:long>,timestamp:array<long>,"
    "indicators:struct<quote:array<struct<open:array<double>,high:array<double>,low:array<double>,close:array<double>,volume:array<double>>>>,"
    "events:struct<dividends:map<string,struct<amount:double,date:long>>,splits:map<string,struct<date:long,numerator:double,denominator:double>>>>>>"
)


def _result(payloads: DataFrame) -> DataFrame:
    """``payloads`` (isin, payload) that hold a result; others are told by ``failures``."""
    return payloads.select("isin", F.from_json("payload", PAYLOAD).alias("p")).select("isin", F.col("p.chart.result")[0].alias("r")).where("r IS NOT NULL AND r.meta IS NOT NULL")


def failures(payloads: DataFrame) -> DataFrame:
    """isins whose payload holds no chart."""
    return payloads.select("isin").join(_result(payloads).select("isin"), "isin", "left_anti")


def local_date(epoch: Column, zone: Column, offset: Column) -> Column:
    """The exchange's day of an instant; by the offset where no zone is given."""
    by_zone = F.when(zone.isNotNull(), F.to_date(F.from_utc_timestamp(F.timestamp_seconds(epoch), F.coalesce(zone, F.lit("UTC")))))
    return F.coalesce(by_zone, F.to_date(F.timestamp_seconds(epoch + F.coalesce(offset, F.lit(0)))))


def bars(payloads: DataFrame) -> DataFrame:
    """isin, date, open, high, low, close, volume, currency: short arrays are filled with nulls, bars without a close dropped, of a day the last kept."""
    r = _result(payloads).withColumn("q", F.col("r.indicators.quote")[0])
    zipped = F.arrays_zip(F.col("r.timestamp").alias("t"), *(F.coalesce(F.col(f"q.{c}"), F.array().cast("array<double>")).alias(c) for c in ("open", "high", "low", "close", "volume")))
    rows = r.select("isin", "r.meta", F.posexplode(zipped).alias("at", "b")).where("b.t IS NOT NULL AND b.close IS NOT NULL")
    day = local_date(F.col("b.t"), F.col("meta.exchangeTimezoneName"), F.col("meta.gmtoffset"))
    last = rows.select("isin", day.alias("date"), "at", "b", "meta").groupBy("isin", "date").agg(F.max_by(F.struct("b", "meta"), "at").alias("x"))
    return last.select("isin", "date", *(F.col(f"x.b.{c}").alias(c) for c in ("open", "high", "low", "close", "volume")), F.col("x.meta.currency").alias("currency"))


def actions(payloads: DataFrame) -> DataFrame:
    """isin, date, kind, amount, ratio, currency of dividends and splits."""
    r = _result(payloads)
    zone = (F.col("r.meta.exchangeTimezoneName"), F.col("r.meta.gmtoffset"))
    d = r.select("isin", "r", F.explode(F.map_values("r.events.dividends")).alias("e")).select("isin", local_date(F.col("e.date"), *zone).alias("date"), F.lit("dividend").alias("kind"), F.col("e.amount").alias("amount"), F.lit(None).cast("double").alias("ratio"), F.col("r.meta.currency").alias("currency"))
    ratio = F.when(F.col("e.denominator") > 0, F.col("e.numerator") / F.col("e.denominator"))
    s = r.select("isin", "r", F.explode(F.map_values("r.events.splits")).alias("e")).select("isin", local_date(F.col("e.date"), *zone).alias("date"), F.lit("split").alias("kind"), F.lit(None).cast("double").alias("amount"), ratio.alias("ratio"), F.col("r.meta.currency").alias("currency"))
    return d.unionByName(s)


#: Answers that are worth another try.
RETRIED = (408, 425, 429, 500, 502, 503, 504)


class Refused(Exception):
    """An answer other than a payload; ``status`` is None where there was no answer at all."""

    def __init__(self, status: int | None):
        super().__init__(f"status {status}")
        self.status = status


class Retrying:
    """A transport that asks ``transport`` again, ``tries`` times in all and with growing, uneven pauses, where that may help."""

    def __init__(self, transport, tries: int = 4, pause: float = 0.5):
        self.transport, self.tries, self.pause = transport, tries, pause

    def __call__(self, symbol, start, end):
        import random
        import time

        for k in range(self.tries):
            try:
                return self.transport(symbol, start, end)
            except Refused as e:
                if k + 1 == self.tries or e.status is not None and e.status not in RETRIED:
                    raise
            time.sleep(self.pause * 2**k * (0.5 + random.random()))


def fetch(requests: DataFrame, transport, tasks: int = 16) -> DataFrame:
    """(isin, payload, error) of ``requests`` (isin, symbol, start, end) by ``transport(symbol, start, end) -> text``.

    A symbol that several funds share is asked once; a failure is a row, not an exception.
    """
    import os

    import pandas as pd

    # workers import what the transport refers to, wherever the driver runs
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = requests.sparkSession.sparkContext.environment
    env["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([*filter(None, env.get("PYTHONPATH", "").split(os.pathsep)), root]))

    def run(frames):
        for f in frames:
            out = []
            for symbol, start, end in zip(f["symbol"], f["start"], f["end"]):
                try:
                    out.append((symbol, transport(symbol, start, end), None))
                except Exception as e:  # noqa: BLE001
                    out.append((symbol, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["symbol", "payload", "error"])

    asked = requests.groupBy("symbol").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    got = asked.repartition(tasks, "symbol").mapInPandas(run, "symbol string, payload string, error string")
    return requests.select("isin", "symbol").join(got, "symbol").select("isin", "payload", "error")
