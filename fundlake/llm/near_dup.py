"""Near-duplicate components of whole texts: one-permutation MinHash with optimal densification.

1. Every document's distinct 5-word shingles give a class key (documents of equal sets are one class,
   so copies of any number are one node) and a signature of 128 values.
2. Each class enters 32 buckets of 4 values.  Two classes of similarity 0.75 share none with
   probability 5e-6.  In each bucket the smallest node is the centre of a star: a bucket of m nodes
   gives m - 1 candidate edges.
3. Candidates whose sizes or signatures rule 0.75 out (fewer than half of the signature equal, 6.5
   standard deviations below) go; the others are confirmed on their full shingle sets.
4. Confirmed edges give components.  Where a bucket still holds nodes of several components that its
   centre has not settled, those nodes take an exact path: a prefix-filtered set join finds every
   pair across components, confirmed likewise, and the components are joined.  No bucket is cut.

Texts of candidates alone are shuffled, once for each role.  Joins have one row per key on one side
or are on candidate ids, which adaptive execution splits where a hub is hot; aggregates combine
before they shuffle.  Nothing is collected or broadcast.

Defined cases: a document without words has no shingles and is linked with nothing; a null doc_id
takes no part (component null, kept); rows that repeat a doc_id share a component; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm import shingles as sh
from fundlake.llm.common import discard, materialise, ship, slices
from fundlake.llm.components import components

BINS, ROWS = 128, 4


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the class key (two longs, null without shingles) and the signature of every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(1)):
                n, hi, lo, sig = [], [], [], []
                for t in texts:
                    s = sh.shingles(t)
                    key = xxhash.xxh3_128_intdigest(s) if len(s) else None
                    n.append(len(s))
                    hi.append(None if key is None else (key >> 64) - (1 << 63))
                    lo.append(None if key is None else (key & ((1 << 64) - 1)) - (1 << 63))
                    sig.append(sh.signature(s, BINS).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "hi", "lo", "sig"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, hi long, lo long, sig binary")


def buckets(classes: DataFrame) -> DataFrame:
    """(key, node) for every band of every class's signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = [sh.band_keys(np.frombuffer(x, np.uint32), ROWS) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.repeat(b.column(0).to_numpy(), BINS // ROWS))], ["key", "node"])

    return classes.select("node", "sig").mapInArrow(run, "key long, node long")


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and signatures leave possible."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, BINS) for c in ("sig_a", "sig_b"))
                yield b.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) * 2 >= BINS))

    sized = pairs.join(side("a"), "a").join(side("b"), "b").where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are linked; ``texts``: (node, text)."""
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for b in batches:
            keep = []
            for a, x, y in zip(*(b.column(c).to_pylist() for c in ("a", "text_a", "text_b"))):
                if a != last:
                    last, held = a, sh.shingles(x)
                keep.append(sh.linked(held, sh.shingles(y)))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def prefix_pairs(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Every pair of ``nodes`` (node, component) across components that can be linked.

    Linked sets share one of the rarest n - ceil(0.75 n) + 1 shingles of each, and sets of n and m
    shingles share o = ceil(3 (n + m) / 7) at least: the first shingle they share, in order of rarity,
    has at most n - o + 1 and m - o + 1 places up to it.  So of two texts near the same common one only
    those come out that are themselves about that near.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, some in slices(b.column(1), 1_000_000):
                sets = [sh.shingles(t) for t in some]
                n = [len(s) for s in sets]
                rows = b.column(0).slice(at, len(some)).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rows, n)), pa.array(np.repeat(n, n)), pa.array(np.concatenate(sets).view(np.int64))], ["node", "n", "s"])

    rows = texts.join(nodes.select("node"), "node", "left_semi").select("node", "text").mapInArrow(run, "node long, n long, s long")
    rows, made = materialise(rows, "shingles")
    often = rows.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    # a shingle of one node alone comes first in the order of rarity: it only moves the others back
    shared = rows.join(often, "s")
    alone = shared.groupBy("node").agg(F.count("*").alias("shared"))
    order = F.row_number().over(Window.partitionBy("node").orderBy("df", "s"))
    prefix = shared.join(alone, "node").withColumn("at", F.col("n") - F.col("shared") + order).where("at <= n - cast(ceil(0.75 * n) as long) + 1").join(nodes, "node").select("s", "node", "component", "n", "at")
    prefix, made_prefix = materialise(prefix, "prefixes")
    several = prefix.groupBy("s").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("s")
    live = prefix.join(several, "s", "left_semi")
    x, y = live.alias("x"), live.alias("y")
    met = F.expr("(3 * (x.n + y.n) + 6) div 7")
    early = (F.col("x.at") <= F.col("x.n") - met + 1) & (F.col("y.at") <= F.col("y.n") - met + 1)
    found = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")) & early)
    pairs, made_pairs = materialise(found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "pairs")
    discard(nodes.sparkSession, made, made_prefix)
    return pairs


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    spark = docs.sparkSession
    sketches, _ = materialise(sketch(docs), "sketches")
    some = sketches.where("hi is not null and doc_id is not null")
    # the signature is a function of the class, so any row's will do
    classes = some.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"))
    classes, _ = materialise(classes, "classes")
    owners = some.join(classes.withColumnRenamed("node", "doc_id"), ["hi", "lo", "doc_id"], "left_semi").select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sig").dropDuplicates(["node", "sig"])
    owners, old_owners = materialise(owners, "owners")

    rows, old_rows = materialise(buckets(owners).distinct(), "buckets")
    centres = rows.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("m")).where("m > 1")
    stars = rows.join(centres, "key").where("node <> a").select("key", "a", F.col("node").alias("b"), "m")
    stars, old_stars = materialise(stars, "stars")
    discard(spark, old_rows)
    pairs, old_pairs = materialise(plausible(stars.select("a", "b").distinct(), owners), "pairs")

    # nodes whose texts are needed: those of plausible pairs, and those in buckets of three or more, which the exact path may ask for
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(stars.where("m > 2").select(F.col("b").alias("node"))).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).join(asked, "node", "left_semi").dropDuplicates(["node", "text"])
    texts, old_texts = materialise(texts, "texts")
    links, old_links = materialise(confirm(pairs, texts), "links")
    first = components(links)

    # a bucket's members other than its centre, which it has settled with each of them
    open_ = stars.where("m > 2").select("key", F.col("b").alias("node")).join(first, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    open_, old_open = materialise(open_, "open")
    unsettled = open_.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    nodes, old_nodes = materialise(open_.join(unsettled, "key", "left_semi").select("node", "component").distinct(), "unsettled")
    more = confirm(plausible(prefix_pairs(nodes, texts), owners), texts)
    ends, old_ends = materialise(links.unionByName(more), "links")
    final = components(ends)
    discard(spark, old_owners, old_stars, old_pairs, old_texts, old_links, old_open, old_nodes, old_ends)

    by_class = classes.join(final, "node", "left").select("hi", "lo", F.coalesce("component", "node").alias("component_id"))
    return (
        sketches.drop("sig")
        .join(by_class, ["hi", "lo"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
