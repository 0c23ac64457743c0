"""Sources by name: what they need of each other, and a run that no single failure ends."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators import fold
from fundlake.schema import conform, struct


@dataclass(frozen=True)
class Adapter:
    """``fetch`` gives (funds, listings); it is passed those of spark, refresh, listings, isins and whatever else a run offers that its signature names."""

    name: str
    trust: int
    fetch: Callable
    needs: tuple[str, ...] = ()


@dataclass
class Result:
    name: str
    trust: int
    ok: bool
    funds: DataFrame
    listings: DataFrame
    n_funds: int = 0
    error: str = ""


@dataclass
class Registry:
    adapters: dict[str, Adapter] = field(default_factory=dict)

    def add(self, adapter: Adapter) -> None:
        if adapter.name in self.adapters:
            raise ValueError(f"two sources are called {adapter.name}")
        self.adapters[adapter.name] = adapter

    def select(self, names: list[str] | None = None) -> list[Adapter]:
        unknown = sorted(set(names or ()) - set(self.adapters))
        if unknown:
            raise KeyError(f"unknown sources: {unknown}")
        return [a for n, a in self.adapters.items() if names is None or n in names]


def plan(adapters: list[Adapter]) -> list[list[Adapter]]:
    """Waves: a source runs after those it needs, if they run at all; within a wave by falling trust and name.

    Sources that need each other in a circle run last, together, rather than never.
    """
    left, done, waves = sorted(adapters, key=lambda a: (-a.trust, a.name)), set(), []
    chosen = {a.name for a in adapters}
    while left:
        ready = [a for a in left if not (set(a.needs) & chosen) - done] or left
        waves.append(ready)
        done |= {a.name for a in ready}
        left = [a for a in left if a.name not in done]
    return waves


def _accepted(f: Callable, offered: dict) -> dict:
    names = inspect.signature(f).parameters
    return offered if any(p.kind is p.VAR_KEYWORD for p in names.values()) else {k: v for k, v in offered.items() if k in names}


def run_one(spark: SparkSession, adapter: Adapter, offered: dict, folder: str) -> Result:
    """The adapter's tables, written to ``folder``: a source that fails while it is read fails here."""
    try:
        made = adapter.fetch(**_accepted(adapter.fetch, {"spark": spark, **offered}))
        out = []
        for df, name in zip(made, ("funds", "listings")):
            path = f"{folder}/{adapter.name}-{name}"
            conform(df, name).write.mode("overwrite").parquet(path)
            out.append(spark.read.schema(struct(name)).parquet(path))
        return Result(adapter.name, adapter.trust, True, *out, out[0].count())
    except Exception as e:  # noqa: BLE001 - one source must not end the run
        none = [spark.createDataFrame([], struct(n)) for n in ("funds", "listings")]
        return Result(adapter.name, adapter.trust, False, *none, 0, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}")


def run(spark: SparkSession, adapters: list[Adapter], folder: str, **offered) -> list[Result]:
    """Every wave in turn; later ones are offered what the earlier ones found, merged: ``listings`` and ``isins``."""
    results: list[Result] = []
    for wave in plan(adapters):
        merged = merge(spark, results) if results else None
        more = {"listings": merged[1], "isins": merged[0].select("isin")} if merged else {}
        results += [run_one(spark, a, {**offered, **more}, folder) for a in wave]
    return results


def merge(spark: SparkSession, results: list[Result]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(funds, listings, provenance) of the sources that succeeded."""
    ok = {r.name: (r.trust, r) for r in results if r.ok}
    if not ok:
        raise ValueError("no source gave anything: " + "; ".join(f"{r.name}: {r.error}" for r in results))
    fields = [f.name for f in struct("funds").fields if f.name not in ("isin", "data_sources", "last_updated")]
    stacked = fold.stack({n: (t, r.funds.drop("data_sources")) for n, (t, r) in ok.items()})
    folded = fold.trust_fold(stacked, "isin", fields, latest="last_updated")
    provenance = fold.provenance(stacked, "isin", [f for f in fields])
    funds = conform(fold.bound_aum(folded, provenance), "funds")
    lines = fold.canonical_mics(fold.stack({n: (t, r.listings) for n, (t, r) in ok.items()}).where("exchange_mic IS NOT NULL"))
    columns = [f.name for f in struct("listings").fields if f.name not in ("isin", "exchange_mic", "is_primary")]
    one = lines.groupBy("isin", "exchange_mic").agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(-F.col("trust"), "source", "seq"))).alias(c) for c in columns))
    listings = conform(fold.primary_flags(one.join(funds.select("isin"), "isin", "left_semi")), "listings")
    return funds, listings, provenance


def report(spark: SparkSession, results: list[Result]) -> DataFrame:
    """(source, trust, ok, funds, error), in the order of trust."""
    return spark.createDataFrame([(r.name, r.trust, r.ok, r.n_funds, r.error) for r in sorted(results, key=lambda r: (-r.trust, r.name))], "source string, trust int, ok boolean, funds long, error string")
