"""Connected components of a stored edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of ``edges`` (columns a, b); a component is named by its smallest node.

    Each round takes the smallest name among the neighbours and then the name of that name, so stars end
    after two rounds and chains after a logarithmic number. Every round is stored in the shared folder.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "edges")
    names = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.col("node")).alias("component")), "components")
    while True:
        nearby = both.join(names.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near"))
        lower = names.join(nearby, "node").select("node", "component", F.least("component", "near").alias("low"))
        of_name = names.select(F.col("node").alias("low"), F.col("component").alias("further"))
        following = materialize(lower.join(of_name, "low").select(
            "node", F.least("low", "further").alias("component"), F.col("component").alias("_was")), "components")
        changed = following.where("component <> _was").limit(1).count()
        names = following.drop("_was")
        if not changed:
            return names
