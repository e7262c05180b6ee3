"""Connected components of a table of links, as a few joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.operators.joins import hot_join
from grantflow.session import settle


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (least node of its component) for the nodes of ``a``-``b`` links.

    Every round takes the least label among neighbours and then the label of that
    label, so paths halve.  Labels are written every round; a lost executor reads
    them again.  A node that a third of all links share is split by the join.
    ``links`` should be a written table, since every round reads it; repeated links
    and links of a node to itself do no harm.
    """
    one, other = links.select("a", "b"), links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = one.union(other)
    most = 2 * links.count()
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), most)
    while True:
        near = hot_join(both.withColumnRenamed("b", "node"), labels, ["node"], "inner")
        near = near.select(F.col("a").alias("node"), "label", F.lit(None).cast("bigint").alias("own"))
        told = near.union(labels.select("node", "label", F.col("label").alias("own")))
        moved = told.groupBy("node").agg(F.max("own").alias("label"), F.min("label").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        new = settle(hot_join(moved, jump, ["new"], "inner").select("node", "label", F.least("new", "far").alias("new")), most)
        done = new.where("label <> new").isEmpty()
        labels = new.select("node", F.col("new").alias("label"))
        if done:
            return labels


def with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels as :func:`components` gives them after further ``a``-``b`` links (a written table).

    Whole components are joined by their labels, so the rounds read the further links
    only, and the nodes are labelled anew once.
    """
    ends, further = links, links.count()
    for end in ("a", "b"):
        ends = hot_join(ends, labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}")), [end], "left")
    between = settle(ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b"), further)
    moved = components(between).select(F.col("node").alias("label"), F.col("label").alias("new"))
    alone = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().join(labels, "node", "left_anti")
    most = labels.count() + 2 * further
    held = labels.select("node", "label").union(alone.select("node", F.col("node").alias("label")))
    return settle(hot_join(held, moved, ["label"], "left").select("node", F.coalesce("new", "label").alias("label")), most)
