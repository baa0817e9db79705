"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachyline.session import stage


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Each round every node takes the smallest label around it and then its label's label, so
    distances shrink geometrically. Labels live in tables of the shared folder, one per
    round; only the number of changes reaches the driver. Hubs are harmless: a round takes
    minima, which combine before the shuffle, and never gathers neighbours.
    """
    both = stage(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    for _ in range(most_rounds):
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("nearest"))
        lower = labels.join(around, labels["node"] == around["a"]).select("node", F.col("label").alias("old"), F.least("label", "nearest").alias("label"))
        lower = stage(lower, "labels")
        target = lower.select(F.col("node").alias("target"), F.col("label").alias("further"))
        jumped = lower.join(target, lower["label"] == target["target"], "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        labels = stage(jumped, "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
