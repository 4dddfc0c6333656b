"""Connected components of an edge table, by contracting stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import FEW, discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component, for all nodes of ``edges (a, b)``.

    Each round links the larger neighbours of every node to its smallest neighbour, and then
    the smaller ones, until every edge leads to the smallest node of its component. A
    component of any size takes a number of rounds that grows with its logarithm. Rounds
    are written to the shared folder; no task holds a component, but one takes all edges
    where these are at most ``FEW``.
    """
    spark = edges.sparkSession
    current = stored(_normal(edges.select("a", "b")), "edges")
    rows, digests = 0, None
    while True:
        before, (rows, *digests) = (rows, digests), _state(current)
        if (rows, digests) == before:
            break
        here = current.coalesce(1) if rows <= FEW else current
        both = here.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
                                     ).alias("e")).select("e.*")
        large = _star(both, F.col("b") > F.col("a"))
        small = stored(_normal(_star(large, None)), "edges")
        discard(spark, current)
        current = small
    return current.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("component")),
        F.struct(F.col("b").alias("node"), F.col("b").alias("component")))).alias("e")).select("e.*").distinct()


def _state(edges: DataFrame) -> tuple:
    """The number of edges and two digests of 64 bits: the same for the same set of edges."""
    return tuple(edges.agg(F.count("*"), *(
        F.coalesce(F.bit_xor(F.xxhash64(F.lit(salt), "a", "b")), F.lit(0)) for salt in (0, 1))).first())


def _normal(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a <> b").distinct()


def _star(edges: DataFrame, larger) -> DataFrame:
    """Link neighbours b of a node a to the least of a and its neighbours."""
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    linked = edges if larger is None else edges.filter(larger)
    out = linked.join(least, "a")
    if larger is not None:
        return out.select(F.col("b").alias("a"), F.col("m").alias("b"))
    # Every node also has an edge to its own least neighbour.
    return out.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
