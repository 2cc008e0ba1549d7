"""Connected components of an edge table as Spark jobs, for the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.session import materialize

#: A node of more neighbours than this is heavy, or than its share of all links, whichever is more.
HEAVY_LINKS = 1_000
#: The links of a heavy node are at least one in so many, which bounds the heavy nodes' number.
HEAVY_SHARE = 10_000


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) for every id that ``edges(a, b)`` names.

    Alternating large-star and small-star steps. Each step is a minimum per node, which combines
    before its shuffle, and a join of the edges with these minima. The links of a heavy node (a star's
    centre) stay where they are in that join: the minima of the heavy nodes, which are at most
    ``2 * HEAVY_SHARE``, are broadcast. Every round is written to the shared folder, so the lineage
    stays short and a lost executor costs a re-read. The driver sees one row per round: the count
    and a hash of the edges, to find the end. Loops, nulls and repeated edges are dropped first.
    """
    stars = materialize(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = _signature(stars)
    while before[0]:
        moved = materialize(_large_star(stars, _heavy(before[0])), "moved")
        stars = materialize(_small_star(moved, _heavy(before[0])), "stars")
        after = _signature(stars)
        if after == before:
            break
        before = after
    centres = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)


def _signature(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _heavy(links: int) -> int:
    """The most links of a node that is not heavy; the large-star step counts each link twice."""
    return max(HEAVY_LINKS, links // HEAVY_SHARE)


def _with_minima(edges: DataFrame, minima: DataFrame, heavy: int) -> DataFrame:
    """``u, v, m``: the edges with the minima ``u, m, n`` of their first nodes, ``n`` being their edges' number."""
    most = F.broadcast(minima.where(F.col("n") > heavy).select("u", "m"))
    marked = edges.join(most, "u", "left")
    light = minima.where(F.col("n") <= heavy).select("u", "m")
    return marked.where("m is not null").unionByName(marked.where("m is null").drop("m").join(light, "u"))


def _large_star(stars: DataFrame, heavy: int) -> DataFrame:
    """Every neighbour above a node moves to the smallest node in reach of it."""
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    minima = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    above = _with_minima(both.where("v > u"), minima, heavy)
    return above.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, heavy: int) -> DataFrame:
    """The neighbours below a node, and the node, move to the smallest of them."""
    minima = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _with_minima(edges, minima, heavy).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(minima.select("u", F.col("m").alias("v"))).distinct()
