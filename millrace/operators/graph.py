"""Connected components of a bipartite table of nodes and keys, in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.runtime import materialize


def components(edges: DataFrame, node: str = "node", key: str = "key") -> DataFrame:
    """(node, label): nodes that share keys, in chains, get the least node of their component.

    A round offers the least label of each key to its nodes and to their present labels, then each node takes
    the label of its label (pointer jumping), so that chains of any length close in about log2 rounds. A
    round is partial aggregations and equi-joins; lineage is cut by a written table. It ends when no label
    moves; there is no cap on rounds. A null node or key joins nothing; an empty table gives an empty result.
    """
    edges = edges.select(F.col(node).alias("node"), F.col(key).alias("key")).filter("node is not null and key is not null")
    edges = materialize(edges.distinct())
    labels = edges.select("node", F.col("node").alias("label")).distinct()
    while True:
        held = materialize(edges.join(labels, "node"))
        least = held.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most").select("key", "least")
        offers = held.join(least, "key").select(F.explode(F.array("node", "label")).alias("node"), "least").groupBy("node").agg(F.min("least").alias("least"))
        if offers.isEmpty():
            return held.select("node", "label").distinct()
        lower = materialize(labels.join(offers, "node", "left").select("node", F.least("label", "least").alias("label")))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = materialize(lower.join(jump, "label").select("node", F.col("next").alias("label")))
