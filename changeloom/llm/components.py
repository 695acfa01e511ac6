"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> node, component: one of the nodes that links reach, the same for all of them, for every node that has a link.

    Each round every node goes up to the first of itself and its neighbours, links are drawn between those, and the ones that have become loops go. The first round's order is by
    number, so a star around its smallest node is done at once; later ones are by a hash, so chains shrink by a constant factor. Only what is left is carried on: a round costs two
    joins over the links that remain. At the end the steps up are put together, smallest first. The driver holds nothing but the list of tables.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    steps: list[DataFrame] = []
    while not steps or not edges.isEmpty():
        order = (lambda x: F.col(x)) if not steps else (lambda x, turn=len(steps): F.xxhash64(F.col(x), F.lit(turn)))
        both = edges.select("a", "b").union(edges.select("b", "a"))
        first = both.groupBy("a").agg(F.min(F.struct(order("b").alias("h"), F.col("b").alias("up"))).alias("low"))
        step = stored(first.select(F.col("a").alias("node"), F.least(F.struct(order("a").alias("h"), F.col("a").alias("up")), F.col("low"))["up"].alias("up")), "steps")
        steps.append(step)
        up = lambda x: step.select(F.col("node").alias(x), F.col("up").alias(f"{x}_up"))
        moved = edges.join(up("a"), "a").join(up("b"), "b").select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).where("a <> b").distinct()
        edges = stored(moved, "edges")
    labels = steps.pop().withColumnRenamed("up", "component")
    while steps:
        further = labels.select(F.col("node").alias("up"), "component")
        labels = stored(steps.pop().join(further, "up", "left").select("node", F.coalesce("component", "up").alias("component")), "labels")
    return labels


def joined_by(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, component) when further links (a, b) have joined some of the components; nodes without a label are components of their own."""
    of = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"{x}_in"))
    drawn = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b"))
    merged = components(drawn)
    moved = labels.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return stored(moved.unionByName(merged.join(labels, "node", "left_anti").select("node", "component")), "labels")
