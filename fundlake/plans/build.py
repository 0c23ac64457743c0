"""The whole build: sources to published tables, stage by stage.

Every stage reads the tables that earlier ones left under the root and writes its own, so that a run can begin at any
stage; a stage that is passed over must have left its tables before.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators import adjust, eligibility, fold, fx, publish, stats
from fundlake.plans import adapters
from fundlake.schema import conform
from fundlake.sources import charts, evidence, store
from fundlake.sources.store import _exists


@dataclass
class Config:
    root: str
    as_of: str
    sources: list[adapters.Adapter]
    transport: object  # symbol, start, end -> payload
    rates: DataFrame
    evidence: str
    runs: tuple[str, ...] = ()  # all, if none is named
    inception: str = "2000-01-01"
    benchmark: str | None = None
    rounds: int = 3
    min_funds: int = publish.MIN_FUNDS
    synthetic: bool = False
    tasks: int = 16


@dataclass
class Report:
    """What each stage took and left: (stage, seconds, table, rows), in order."""

    lines: list[tuple[str, float, str, int]] = field(default_factory=list)
    sources: list[tuple] = field(default_factory=list)

    def to_dict(self) -> dict:
        return {"stages": [dict(zip(("stage", "seconds", "table", "rows"), x)) for x in self.lines], "sources": [dict(zip(("source", "trust", "ok", "funds", "error"), x)) for x in self.sources]}

    def extrapolate(self, funds: int) -> float | None:
        """Seconds that ``funds`` funds would take, in proportion; None where nothing was built."""
        built = next((n for _, _, table, n in self.lines if table == "funds"), 0)
        return sum({s: t for s, t, _, _ in self.lines}.values()) * funds / built if built else None

    def render(self) -> str:
        return "\n".join(f"{s:12} {t:8.1f} s  {table:20} {n:>12,}" for s, t, table, n in self.lines)


def _universe(spark, cfg, read):
    results = adapters.run(spark, cfg.sources, f"{cfg.root}/sources")
    funds, listings, provenance = adapters.merge(spark, results)
    return {"funds": funds, "listings": listings, "provenance": provenance, "sources": adapters.report(spark, results)}


def _eligibility(spark, cfg, read):
    told = evidence.load(spark, cfg.evidence)
    made = eligibility.verdicts(read("funds"), told.rows, cfg.as_of, told.replication)
    return {"eligible": conform(made, "funds"), "broker_availability": conform(eligibility.broker_availability(told.rows, told.not_etf), "broker_availability")}


def _resolve(spark, cfg, read):
    return {"symbols": fold.symbol_candidates(read("listings"))}


def _prices(spark, cfg, read):
    epoch = lambda day: F.unix_timestamp(F.lit(day).cast("timestamp"))
    bars, actions = f"{cfg.root}/bars", f"{cfg.root}/actions"

    def fetch(candidates: DataFrame) -> DataFrame:
        asked = candidates.select("isin", F.col("yahoo_ticker").alias("symbol"), epoch(cfg.inception).alias("start"), (epoch(cfg.as_of) + 86400).alias("end"))
        path = f"{cfg.root}/payloads"
        charts.fetch(asked, cfg.transport, cfg.tasks).write.mode("overwrite").parquet(path)
        payloads = spark.read.parquet(path).where("error IS NULL").select("isin", "payload")
        store.upsert_actions(spark, charts.actions(payloads), actions)
        return charts.bars(payloads).withColumn("currency", F.coalesce("currency", F.lit("EUR")))

    store.rounds(spark, read("symbols"), fetch, bars, cfg.rounds)
    if not _exists(spark, bars):
        raise ValueError("no fund has prices")
    return {"manifest": store.manifest(store.read(spark, bars))}


def _fx(spark, cfg, read):
    bars = store.read(spark, f"{cfg.root}/bars").select("isin", "date", "close", "currency")
    actions = spark.read.parquet(f"{cfg.root}/actions").select("isin", "date", "kind", "amount", "ratio", "currency")
    return {"bars_eur": fx.to_eur(bars, cfg.rates, ("close",), horizon=cfg.as_of).where("close IS NOT NULL"), "actions_eur": fx.to_eur(actions, cfg.rates, ("amount",), horizon=cfg.as_of)}


def _adjust(spark, cfg, read):
    return {"adjusted": adjust.adjust(read("bars_eur"), read("actions_eur")), "adjustments": adjust.report(adjust.event_factors(read("bars_eur"), read("actions_eur")))}


def _stats(spark, cfg, read):
    panel = stats.clean(read("adjusted"), cfg.as_of)
    made = stats.performance(panel, stats.own_benchmark(panel, cfg.benchmark) if cfg.benchmark else None, read("eligible"))
    made = stats.thin_gate(made.withColumn("computed_at", F.lit(cfg.as_of).cast("date")))
    euro = spark.createDataFrame([], "currency string, date date, rate_to_eur double")
    return {"performance": conform(made, "performance"), "returns_yearly": conform(stats.yearly_returns(panel), "returns_yearly"), "returns_monthly": conform(stats.monthly_returns(panel), "returns_monthly"), "index": publish.weekly_index(read("adjusted"), euro)}


def _write(spark, cfg, read):
    tables = {n: read("eligible" if n == "funds" else n) for n in publish.PUBLISHED}
    publish.check(spark, {n: t for n, t in tables.items() if n in ("funds", "listings")}, as_of=cfg.as_of, synthetic=cfg.synthetic, min_funds=cfg.min_funds)
    out = f"{cfg.root}/published"
    publish.export(spark, tables, out, cfg.as_of, read("index"), cfg.synthetic)
    publish.write_provenance(read("provenance"), read("sources"), out)
    wide = publish.screener(tables["funds"], tables["listings"], tables["performance"].drop("base_currency"), publish.coverage(read("index")))
    return {"screener": publish.publishable(wide)}


#: Stages in order, and the tables that each leaves.
STAGES = {
    "universe": (_universe, ("funds", "listings", "provenance", "sources")),
    "eligibility": (_eligibility, ("eligible", "broker_availability")),
    "resolve": (_resolve, ("symbols",)),
    "prices": (_prices, ("manifest",)),
    "fx": (_fx, ("bars_eur", "actions_eur")),
    "adjust": (_adjust, ("adjusted", "adjustments")),
    "stats": (_stats, ("performance", "returns_yearly", "returns_monthly", "index")),
    "write": (_write, ("screener",)),
}


def run(spark: SparkSession, cfg: Config) -> Report:
    """Runs the stages that ``cfg.runs`` names; the report is also written, as JSON, beside the tables."""
    unknown = sorted(set(cfg.runs) - set(STAGES))
    if unknown:
        raise KeyError(f"unknown stages: {unknown}")
    report, at = Report(), lambda table: f"{cfg.root}/tables/{table}"
    read = lambda table: spark.read.parquet(at(table))
    for name, (stage, tables) in STAGES.items():
        if cfg.runs and name not in cfg.runs:
            missing = [t for t in tables if not _exists(spark, at(t))]
            if missing and any(list(STAGES).index(x) > list(STAGES).index(name) for x in cfg.runs):
                raise ValueError(f"stage {name} was passed over and has left no {', '.join(missing)}")
            continue
        began = time.time()
        for table, df in stage(spark, cfg, read).items():
            df.write.mode("overwrite").option("compression", "zstd").parquet(at(table))
        took = round(time.time() - began, 3)
        report.lines += [(name, took, t, read(t).count()) for t in tables]
        if name == "universe":
            report.sources = [tuple(r) for r in read("sources").collect()]
            if not report.lines[0][3]:
                raise ValueError("no funds")
    publish.write_json(spark, report.to_dict(), f"{cfg.root}/report.json")
    return report
