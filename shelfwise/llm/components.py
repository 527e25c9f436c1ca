"""Connected components of a link table, as alternating star contraction.

The method is the published large-star / small-star scheme. Each round is a few
joins and grouped minima; no node's neighbours are ever gathered in one row, so
a node may have any number of links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.staging import Scratch, stage


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of each node of ``links`` (columns ``a``, ``b``, longs).

    The component is the smallest node that links reach. Self links and repeated
    links do no harm; rows with a null are ignored. An empty table gives none.
    """
    with Scratch(links.sparkSession) as scratch:
        return scratch.result(_contract(links), "components")


def _contract(links: DataFrame) -> DataFrame:
    edges = stage(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "links",
    )
    before = None
    while (mark := _fingerprint(edges)) != before:
        before = mark
        edges = stage(_small_star(_large_star(edges)), "links")
    own = edges.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(own)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("mark")
    ).first()
    return row.n, row.mark


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of its neighbourhood."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = (
        edges.join(least, "hi")
        .where(F.col("lo") != F.col("m"))
        .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    )
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
