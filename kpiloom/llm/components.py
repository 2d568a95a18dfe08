"""Connected components of a table of links, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.tables import released, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of (a, b) links.

    Each round takes the smallest label among a node's neighbours, then jumps
    from label to label's label, until nothing changes; a star needs two
    rounds, a chain about log(length).  Labels are stored every round, so the
    lineage stays short; a hot node costs a skew-split join and a pre-aggregated
    minimum.  Nothing but a count reaches the driver.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                    .select("node", F.least("node", "b").alias("component")))
    while True:
        seen = edges.join(labels.select(F.col("node").alias("b"), "component"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        near = labels.join(seen, "node") \
            .select("node", F.col("component").alias("old"), F.least("component", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("next"))
        new = stored(near.join(jump, "to", "left")
                     .select("node", "old", F.least("to", F.coalesce("next", "to")).alias("component")))
        labels = new.select("node", "component")
        released(links.sparkSession)
        if new.where("old <> component").isEmpty():
            return labels


def joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """``components`` of the links behind ``found`` (None: none) and of more links.  The rounds run on the
    components that the new links join, each as its smallest node; without such links there is no round."""
    if found is None:
        return components(links)
    side = {c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in ("a", "b")}
    between = stored(links.join(side["a"], "a", "left").join(side["b"], "b", "left")
                     .select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b"))
                     .where("a <> b").distinct())
    if between.isEmpty():
        return found
    to = components(between)
    moved = found.join(to.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left") \
        .select("node", F.coalesce("to", "component").alias("component"))
    return stored(moved.unionByName(to.join(found, "node", "left_anti")))
