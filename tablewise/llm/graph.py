"""Connected components over a table of links, by distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewise.llm.common import stored


def _compress(parent: DataFrame) -> DataFrame:
    """Path compression: doubles every pointer until all nodes point at roots."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parent = stored(parent.join(up, "parent").select(
            "node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")), "union-find")
        moved = parent.where("moved").limit(1).count()
        parent = parent.select("node", "parent")
        if not moved:
            return parent


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between long ids -> (node, component), the least id reachable.

    Each round hooks every node under its least neighbour (a forest, since
    pointers only go down), compresses the paths and contracts the links to the
    roots.  A round leaves at most half of the nodes, so there are
    logarithmically many, each a few shuffles of the links that are left; no
    component is gathered anywhere.  Nodes without a link are not listed; an
    empty table gives an empty one.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while labels is None or links.limit(1).count():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = _compress(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
                           .select("node", F.least("node", "parent").alias("parent")))
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = stored(links.join(left, "a").join(right, "b").where("pa <> pb")
                       .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
        if labels is None:
            labels = parent.select("node", F.col("parent").alias("component"))
        else:
            up = parent.select(F.col("node").alias("component"), F.col("parent").alias("above"))
            labels = stored(labels.join(up, "component", "left")
                            .select("node", F.coalesce("above", "component").alias("component")), "labels")
    return labels
