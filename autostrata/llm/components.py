"""Connected components of a graph that is kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from autostrata.staging import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for each node of ``edges`` (``a``, ``b``, any orderable type).

    Each round takes the smallest root among a node and its neighbours and then the root of that
    root, so long chains shrink by doubling. Roots are combined in each task before they meet; a
    node with any number of edges is no burden. Every round is written, and ends when no root
    changed.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = materialize(both, "edges")
    labels = materialize(
        both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).select(
            F.col("a").alias("node"), "root"
        ),
        "roots",
    )
    while True:
        offered = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("root").alias("offer"))
        )
        nearer = labels.join(offered, F.col("node") == F.col("a"), "left").select(
            "node", F.col("root").alias("old"), F.least("root", "offer").alias("root")
        )
        above = labels.select(F.col("node").alias("_up"), F.col("root").alias("_top"))
        jumped = nearer.join(above, F.col("root") == F.col("_up"), "left").select(
            "node", "old", F.least("root", "_top").alias("root")
        )
        seen = Observation()
        changed = F.count_if(F.col("root") != F.col("old")).alias("changed")
        labels = materialize(jumped.observe(seen, changed), "roots").select("node", "root")
        if not seen.get["changed"]:
            return labels
