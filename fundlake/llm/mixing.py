"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source.  A budget of tokens is dealt from the root down: a node's
children share its budget by integer weights, and a child that holds less than its share gives the
rest to its siblings (by weight, as long as they hold more); only what no sibling can take moves to
the parent's siblings, since the parent's own share was bounded by what its children hold.  With
children in order of capacity over weight this is a closed form of running sums, exact in integers;
of each node's budget at most one token for each child is left over.

A leaf holds ``epochs`` times its tokens.  Budget div tokens epochs are taken whole; of the next, the
documents in the order of a hash of seed, epoch and doc_id as far as their running tokens fit.

DataFrame operations only, no Python in any task.  A leaf may hold a third of all rows: its running
sums are taken over 4096 hash ranges, pre-aggregated before they are shuffled, then over the one range
that the cut falls in.  Texts stay put where Spark measures the leaf table under its broadcast threshold;
beyond that the join has one row for each leaf on one side, and adaptive execution splits hot leaves.

Defined cases: null domain, language or source counts as ``none``; a null or empty text has no tokens; a leaf without
tokens is taken in no epoch; rows that repeat a doc_id (and null doc_ids, which count as ``none``) are
taken or left together; other columns, of whatever name, are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import materialise, plain_names

LEAF = ["domain", "lang", "source"]
#: Query parameters: domains by the number that ends a source's name, and weights by level.
DOMAINS = ("web", "books", "forum")
WEIGHTS = {"domain": {"web": 5, "books": 3, "forum": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {}}


def default_domain(source: Column) -> Column:
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(source.isNotNull() & (number != ""), F.element_at(F.array(*map(F.lit, DOMAINS)), (F.coalesce(number.try_cast("int"), F.lit(0)) % len(DOMAINS) + 1)))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def deal(nodes: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """``nodes`` (weight, capacity, amount: the parent's) with budget."""
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    w = group.orderBy(F.col("capacity") / F.col("weight"), *order)
    before = F.coalesce(F.sum("capacity").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing))
    rows = nodes.withColumn("rest", F.col("amount") - before).withColumn("open", after)
    # full, as are all before it in order: capacity / weight <= rest / open
    rows = rows.withColumn("full", F.col("capacity") * F.col("open") <= F.col("weight") * F.col("rest"))
    level = F.min(F.when(~F.col("full"), F.struct((-F.col("open")).alias("k"), "rest", "open"))).over(group)
    rows = rows.withColumn("level", level)
    return rows.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("(weight * level.rest) div level.open"))).drop("rest", "open", "full", "level")


def budgets(leaves: DataFrame, weights: dict, share: Column, epochs: int) -> DataFrame:
    """domain, lang, source, tokens and budget of every leaf; ``leaves``: (domain, lang, source, tokens)."""
    rows = leaves.withColumn("held", F.col("tokens") * epochs)
    amount = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all")).select(share.cast("long").alias("amount"))
    for i, level in enumerate(LEAF):
        keys = LEAF[: i + 1]
        nodes = rows.groupBy(*keys).agg(F.sum("held").alias("capacity")).withColumn("weight", _weight(level, weights))
        nodes = nodes.join(amount, LEAF[:i]) if i else nodes.join(F.broadcast(amount))  # one row
        amount = deal(nodes, LEAF[:i], [level]).select(*keys, F.col("budget").alias("amount"))
    return leaves.join(amount.withColumnRenamed("amount", "budget"), LEAF)


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("none"))).cast("binary"))


def cuts(light: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``plan`` with whole (epochs taken whole) and cut: of the next epoch the documents whose key is not above it."""
    plan = plan.where("tokens > 0 AND budget > 0").select(*LEAF, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("over"))
    rows = light.join(plan, LEAF).withColumn("key", _key(seed, F.col("whole") + 1, F.col("doc_id"))).withColumn("part", F.substring("key", 1, 3))
    parts = rows.groupBy(*LEAF, "part").agg(F.sum("n_tokens").alias("n"), F.first("over").alias("over"))
    run = Window.partitionBy(*LEAF).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    edge = parts.withColumn("upto", F.sum("n").over(run)).where("over > 0 AND upto > over").groupBy(*LEAF).agg(F.min(F.struct("part", (F.col("upto") - F.col("n")).alias("before"))).alias("edge")).select(*LEAF, "edge.part", "edge.before")
    inside = rows.join(edge, [*LEAF, "part"])
    total = F.sum("n_tokens").over(Window.partitionBy(*LEAF).orderBy("key")) + F.col("before")
    last = inside.withColumn("total", total).where("total <= over").groupBy(*LEAF).agg(F.max("key").alias("last"))
    found = edge.join(last, LEAF, "left").select(*LEAF, F.coalesce("last", "part").alias("cut"))
    return plan.join(found, LEAF, "left").select(*LEAF, "whole", "cut")


def mix(docs: DataFrame, weights: dict | None = None, percent: int = 60, epochs: int = 3, seed: int = 17, domain=default_domain, tokens=n_words) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken, with epoch, domain and n_tokens (columns of those names are replaced)."""
    weights = WEIGHTS if weights is None else weights
    rows, own = plain_names(docs, "epoch", "domain", "n_tokens")
    doc_id, text, lang, source = (F.col(f"c{own.index(c)}") for c in ("doc_id", "text", "lang", "source"))
    none = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    leaf = [none(domain(source)).alias("domain"), none(lang).alias("lang"), none(source).alias("source")]
    light, _ = materialise(rows.select(doc_id.alias("doc_id"), *leaf, tokens(text).alias("n_tokens")), "leaves")
    leaves = light.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    plan = budgets(leaves, weights, F.expr(f"all * {int(percent)} div 100"), epochs)
    cut, _ = materialise(cuts(light, plan, seed), "cuts")
    cut = cut.select(F.struct(*LEAF).alias("leaf"), "whole", "cut")
    taken = F.when(F.col("cut").isNotNull() & (_key(seed, F.col("whole") + 1, doc_id) <= F.col("cut")), 1).otherwise(0)
    rows = rows.withColumn("leaf", F.struct(*leaf)).join(cut, "leaf").withColumn("times", (F.col("whole") + taken).cast("int")).where("times > 0")
    out = rows.select(*(F.col(f"c{i}") for i in range(len(own))), F.explode(F.sequence(F.lit(1), F.col("times"))).alias("epoch"), F.col("leaf.domain").alias("domain"), tokens(text).alias("n_tokens"))
    return out.toDF(*own, "epoch", "domain", "n_tokens")
