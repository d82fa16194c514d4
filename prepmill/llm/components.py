"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.sources.storage import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): the smallest node that links lead to.

    Every node takes the smallest label among its neighbours, then the label of its label, until none
    changes. Each round is written to the shared store. A node with very many links meets only partial
    minima, one per task. Links with a null end are left out; repeated links change nothing.
    """
    whole = links.filter("a is not null and b is not null")
    both = whole.select("a", "b").union(whole.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "links")
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = materialize(labels.select(F.col("a").alias("node"), "label"), "labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("heard"))
        near = labels.join(heard, labels["node"] == heard["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label")
        )
        target = labels.select(F.col("node").alias("at"), F.col("label").alias("beyond"))
        jumped = near.join(target, near["label"] == target["at"], "left").select(
            "node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")
        )
        stored = materialize(jumped, "labels")
        labels = stored.select("node", "label")
        if not stored.filter("label < old").take(1):
            return labels.select("node", F.col("label").alias("component"))
