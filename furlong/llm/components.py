"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from furlong.llm.common import cut_lineage, is_empty, join_sized


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")), "least")
    return join_sized(both, least, ["u"], "n").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    least = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
    moved = join_sized(edges, least, ["u"], "n").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id`` and the smallest id that it is linked to, for every id that is not the smallest itself.

    Each round is written to the shared folder, so a lost executor costs one round. Hubs
    are joined by ``join_sized``. The number of rounds grows with the logarithm of the
    longest chain. Links with a null end, and of an id to itself, say nothing.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = cut_lineage(edges.distinct(), "links")
    while not _is_flat(edges):
        large = cut_lineage(_large_star(edges).distinct(), "large")
        edges = cut_lineage(_small_star(large).distinct(), "small")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _is_flat(edges: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none itself."""
    roots = edges.select(F.col("v").alias("u")).distinct()
    return is_empty(edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")) and is_empty(
        edges.join(roots, "u", "left_semi")
    )
