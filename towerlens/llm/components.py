"""Connected components of a graph of edges, as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the edges ``(a, b)``: the smallest node it is connected to.

    Every round takes the smallest label among a node's neighbours (combined before the shuffle, so a node
    with many edges is no burden) and then the label of that label, so long chains shorten quickly.  Rounds
    start from written tables.  Stops when no label changes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        step = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("jumped"))
        new = stored(step.join(jump, step["label"] == jump["at"], "left").select(
            "node", F.least("label", F.coalesce("jumped", "label")).alias("label"), "old"), "labels")
        if new.filter("label <> old").limit(1).count() == 0:
            return new.select("node", "label")
        labels = new.select("node", "label")


def components_by_first(members: DataFrame) -> DataFrame:
    """``(node, label)`` for ``(node, leader)`` rows: nodes that share a leader, directly or by others, get one label.

    A node's further leaders are tied to its first one, so that only leaders take part in the rounds, however
    many nodes they have.  A node must not have an unbounded number of leaders."""
    led = stored(members.groupBy("node").agg(F.array_sort(F.collect_set("leader")).alias("leaders")), "leaders")
    first = F.col("leaders")[0]
    edges = led.filter(F.size("leaders") > 1).select(
        first.alias("b"), F.explode(F.slice("leaders", 2, F.size("leaders"))).alias("a")).distinct()
    labels = connected_components(edges).withColumnRenamed("node", "leader")
    return led.select("node", first.alias("leader")).join(labels, "leader", "left").select(
        "node", F.coalesce("label", "leader").alias("label"))
