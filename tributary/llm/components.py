"""Connected components of a distributed list of links (union-find by stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import cut


def _is_stars(edges: DataFrame) -> bool:
    """True if every node hangs on one root, and no root hangs on another."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionAll(
        edges.select(F.col("v"), F.lit(0), F.lit(1)))
    wrong = (ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
             .where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("root") == 1))))
    return wrong.agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; a component is named by its smallest node.

    Each round hangs the larger neighbours of a node on the smallest of its neighbourhood, then
    the smaller ones likewise, until only stars are left; the number of rounds grows with the
    logarithm of the longest chain.  Every round is a few joins and aggregations on the links and
    is written to the shared folder.  Links with a null end are ignored; a self link names a
    node that is its own component.
    """
    links = links.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    links = cut(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct(), "links")
    edges = links.where("u <> v")
    while not _is_stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = cut(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
    hung = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return hung.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
                         .unionAll(links.where("u = v").select("u", "v").join(
                             edges.select("u"), "u", "left_anti").select(F.col("u").alias("node"), F.col("v").alias("component")))
                         .distinct())
