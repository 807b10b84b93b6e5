"""Connected components of an edge table by alternating star contractions.

Each round is two group-minimum passes with a bounded-skew join; nothing is collected,
and every round is cut by a table in the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_heavy, materialise


def _with_min(edges: DataFrame) -> DataFrame:
    """Add ``m``, the smallest neighbour of ``u`` (or ``u`` itself), to every edge."""
    mins = materialise(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n")),
                       "star-min")
    return join_heavy(edges, mins, ["u"], edges.count())


def _done(edges: DataFrame) -> bool:
    """Whether the edges (u above v) are stars: every u has one v and is no v itself."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                         F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    open_ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0")
    return open_ends.isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v) of type long; root is
    the smallest node of the component.  Nodes without an edge do not appear."""
    e = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    while not _done(e):
        both = materialise(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))), "large-star")
        large = materialise(_with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .distinct(), "small-star")
        small = _with_min(large).select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        e = materialise(small.where("u <> v").distinct(), "stars")
    # Now every edge joins a node to its root.
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
