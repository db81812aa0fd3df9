"""Connected components of links, as joins: no driver, no unbounded group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.session import settle


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``links`` (columns a, b) reaches.

    Label propagation with pointer jumping over a shrinking set of links: in each round every
    node takes the smallest label among itself and its neighbours, labels follow their own
    labels, and links within one label go. The labels of a round are written to the shared
    folder, so that lineage stays short. Sums and minima are combined before each shuffle, so a
    node with many links costs no more than a row for each task.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    links = settle(links, "links")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    label = settle(ends.select("node", F.col("node").alias("root")), "labels")
    open_links = links
    while not open_links.isEmpty():
        # Each end's root should point to the smaller root of the two.
        hooks = open_links.groupBy(F.col("b").alias("old")).agg(F.min("a").alias("new"))
        hooks = settle(_jumped(hooks), "hooks")
        label = settle(label.join(hooks, label.root == hooks.old, "left").select("node", F.coalesce("new", "root").alias("root")), "labels")
        left, right = (hooks.select(F.col("old").alias(f"{c}_old"), F.col("new").alias(f"{c}_new")) for c in "ab")
        moved = open_links.join(left, F.col("a") == F.col("a_old"), "left").join(right, F.col("b") == F.col("b_old"), "left")
        moved = moved.select(F.coalesce("a_new", "a").alias("x"), F.coalesce("b_new", "b").alias("y")).filter("x <> y")
        open_links = settle(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    return label


def _jumped(hooks: DataFrame) -> DataFrame:
    """``old, new`` with every chain of hooks followed to its end. Hooks lead to smaller nodes, so there is no circle."""
    while True:
        onward = hooks.select(F.col("old").alias("mid"), F.col("new").alias("far"))
        joined = settle(hooks.join(onward, hooks.new == onward.mid, "left").select("old", F.coalesce("far", "new").alias("new"), F.col("far").isNotNull().alias("moved")), "hooks")
        hooks = joined.drop("moved")
        if joined.filter("moved").isEmpty():
            return hooks
