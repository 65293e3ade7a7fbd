"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalguard.llm.base import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its least node) of every node that has a link.

    Each round every node takes the least label among its own and its neighbours', and then
    its label's label, so a path of n nodes takes about log n rounds.  A round is written to
    the shared folder, which cuts the lineage.  Sums over links are partial before they are
    shuffled, and both joins are plain equi-joins, whose large partitions Spark splits.
    """
    pairs = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    pairs = pairs.where("node <> other")
    both = pairs.union(pairs.select(F.col("other").alias("node"), F.col("node").alias("other")))
    # Each node is its own neighbour, so one sum over neighbours also gives its own label.
    own = both.select("node", F.col("node").alias("other"))
    both = stored(both.union(own).distinct(), "links")
    labels = both.groupBy("node").agg(F.min("other").alias("component"))
    labels = stored(labels, "components")
    while True:
        near = both.join(
            labels.select(F.col("node").alias("other"), F.col("component").alias("seen")), "other"
        )
        step = near.groupBy("node").agg(
            F.max(F.when(F.col("node") == F.col("other"), F.col("seen"))).alias("before"),
            F.min("seen").alias("next"),
        )
        step = stored(step, "components_step")
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        after = step.join(jump, "next").select(
            "node", "before", F.least("next", "beyond").alias("component")
        )
        after = stored(after, "components")
        changed = after.where("before <> component").limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels
