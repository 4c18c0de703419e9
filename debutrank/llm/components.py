"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutrank.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of links (a, b); the component is its smallest node.

    Every step hooks each node to its smallest neighbour, follows that pointer once more, and
    replaces the links by those that are left between the groups, so the table shrinks from
    step to step. Links stay distributed; each step is written to the shared folder. Loops and
    repeated links do no harm; null ends must have been removed. No links give no rows.
    """
    links = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    both = links.union(links.select("b", "a"))
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")), "hooks")
    label = label.select("node", F.least("node", "low").alias("component"))
    step = label
    while True:
        further = step.select(F.col("node").alias("component"), F.col("component").alias("next"))
        label = label.join(further, "component", "left")
        label = written(label.select("node", F.coalesce("next", "component").alias("component")), "labels")
        ends_a = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        ends_b = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        left = links.join(ends_a, "a").join(ends_b, "b").filter("ca <> cb")
        links_left = written(left.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "links")
        if links_left.isEmpty():
            return label
        both = links_left.union(links_left.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        step = hooks.select("node", F.least("node", "low").alias("component"))
