"""Connected components by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moniker.sources import materialise


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every end of ``edges`` (a, b: long); one root per component.

    Every round each vertex joins the neighbour that is least by a hash, if less than
    itself, and edges are carried over to the joined vertices, without doubles. Paths
    shrink by a constant factor a round and stars vanish, so that few rounds do. A vertex
    with very many edges is the busy side of plain joins, which Spark splits, and its
    minimum is combined before the shuffle. Every round is written to the shared folder.
    """
    edges = edges.select("a", "b").where(F.col("a") != F.col("b"))
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = materialise(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().select("id", F.col("id").alias("root")), "labels")
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = F.min(F.struct(F.xxhash64("v").alias("h"), "v"))
        own = F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("v"))
        hops = ends.groupBy("u").agg(least.alias("least")).select("u", F.least(own, "least")["v"].alias("to"))
        hops = materialise(hops, "hops")
        labels = labels.join(hops, F.col("root") == F.col("u"), "left")
        labels = materialise(labels.select("id", F.coalesce("to", "root").alias("root")), "labels")
        moved = edges.join(hops.toDF("a", "x"), "a").join(hops.toDF("b", "y"), "b").where("x <> y")
        edges = materialise(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return labels
