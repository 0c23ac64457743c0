"""Connected components by contraction, every round's tables written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node reachable.

    Every round each node hooks to its smallest neighbour, hooks are followed twice, and edges are
    rewritten to what their ends hooked to; nodes that still have edges at least halve.  The
    aggregates combine before they shuffle and the joins have one row for each key on one side, so
    a hub of any degree is no hot spot.
    """
    spark = edges.sparkSession
    edges, old_edges = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes, old_nodes = materialise(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "nodes")
    while not edges.isEmpty():
        hook, old_hook = materialise(edges.select(F.col("b").alias("c"), F.col("a").alias("to")).unionByName(edges.select(F.col("a").alias("c"), F.col("a").alias("to"))).groupBy("c").agg(F.min("to").alias("to")), "hooks")
        twice = hook.join(hook.select(F.col("c").alias("to"), F.col("to").alias("far")), "to", "left").select("c", F.coalesce("far", "to").alias("to"))
        twice, old_twice = materialise(twice, "hooks")
        nodes, made_nodes = materialise(nodes.join(twice, nodes["component"] == twice["c"], "left").select("node", F.coalesce("to", "component").alias("component")), "nodes")
        side = lambda x: twice.select(F.col("c").alias(x), F.col("to").alias(f"{x}2"))
        moved = edges.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("a2", "a").alias("x"), F.coalesce("b2", "b").alias("y"))
        edges, made_edges = materialise(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        discard(spark, old_hook, old_twice, old_nodes, old_edges)
        old_nodes, old_edges = made_nodes, made_edges
    discard(spark, old_edges)
    return nodes
