"""Connected components of an edge table, as rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import save


def _canonical(edges: DataFrame) -> DataFrame:
    return (edges.filter(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) longs -> (node, label): label is one node of the component, the same for all.

    Each round every node of the contracted graph takes its smallest neighbour
    as parent (a partial aggregate, so a hub costs one row per task), parents
    are replaced twice by their own parents, and both the labels and the edges
    move to the parents.  The edge table shrinks every round and is written
    with the labels to the shared folder, so neither lineage nor a lost
    executor costs earlier rounds.  No edges: no rows.
    """
    left = save(_canonical(edges), "edges")
    labels = None
    while left.limit(1).count():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = (both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                   .select("node", F.least("node", "low").alias("parent")))
        for _ in range(2):
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            parents = parents.join(up, "parent").select("node", F.col("top").alias("parent"))
        parents = save(parents, "parents")
        if labels is None:
            labels = parents.withColumnRenamed("parent", "label")
        else:
            up = parents.select(F.col("node").alias("label"), "parent")
            labels = save(labels.join(up, "label", "left")
                          .select("node", F.coalesce("parent", "label").alias("label")), "labels")
        ends = left
        for end in ("a", "b"):
            up = parents.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_top"))
            ends = ends.join(up, end)
        left = save(_canonical(ends.select(F.col("a_top").alias("a"), F.col("b_top").alias("b"))),
                    "edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
