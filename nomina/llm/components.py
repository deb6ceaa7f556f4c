"""Connected components of a link table that no machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.scratch import materialise


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)


def _directed(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of a link: the smallest node reachable.

    Alternates large-star and small-star steps: a node links its larger
    (smaller) neighbours to its smallest one, until every node points at the
    root of its component. Minima are combined before the shuffle and joined
    back, so a node with very many links is never gathered. Each round is
    written, which cuts the lineage; the number of rounds grows with the
    logarithm of the longest chain. Nodes must be longs; null ends are ignored.
    """
    pairs = links.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v")).dropna()
    edges = materialise(_directed(pairs), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(_directed(large), "large")
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(roots, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(_directed(small.unionByName(roots.select("u", F.col("m").alias("v")))), "small")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
