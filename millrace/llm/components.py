"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for every node of ``edges`` (a, b).

    Each round gives a node the smallest label of its neighbours and then the
    label of that label, so that labels travel twice as far in every round. All
    state is written tables in the shared folder; the driver sees one count per
    round. Least labels are combined before the shuffle, and the join splits
    nodes with very many edges. No edges give no rows.
    """
    both = written(
        edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select(F.col("b"), F.col("a"))).distinct()
    )
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        nearer = written(nearer)
        hop = nearer.select(F.col("node").alias("via"), F.col("label").alias("hop"))
        moved = written(
            nearer.join(hop, nearer["label"] == hop["via"], "left").select(
                "node", F.least("label", "hop").alias("label"), "old"
            )
        )
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
