"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``v, comp``: the smallest vertex of its component, for every vertex of
    the edges ``a, b``.

    Each round every vertex points to its smallest neighbour (or itself), the
    labels follow the pointers, and edges are redrawn between the vertices
    pointed to; edges inside one vertex vanish.  A round leaves at most half of
    the vertices that still have edges.  Tables go through the shared folder.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a"))
        point = stored(ends.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("to")), "cc-point")
        if labels is None:
            labels = point.select("v", F.col("to").alias("comp"))
        else:
            hop = point.select(F.col("v").alias("comp"), "to")
            labels = labels.join(hop, "comp", "left").select("v", F.coalesce("to", "comp").alias("comp"))
        labels = stored(labels, "cc-labels")
        left = point.select(F.col("v").alias("a"), F.col("to").alias("ta"))
        right = point.select(F.col("v").alias("b"), F.col("to").alias("tb"))
        new = edges.join(left, "a").join(right, "b").where("ta <> tb")
        edges = stored(new.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "cc-edges")
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("comp"))
    return labels
