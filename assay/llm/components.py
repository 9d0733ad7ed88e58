"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.session import stage


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows ``(node, root)``: the smallest node reachable from each node of ``links (a, b)``.

    Alternating stars: every node hands its larger neighbours to its smallest one, then its smaller
    ones. Each round is two aggregations by node with map-side combining, written to the shared
    folder, so that lost executors repeat one round only. Nulls and loops take no part.
    """
    edges = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    for _ in range(most_rounds):
        large = _star(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), True)
        small = stage(_star(large, False), "links")
        changed = small.exceptAll(edges).limit(1).count() or edges.exceptAll(small).limit(1).count()
        edges = small
        if not changed:
            break
    else:
        raise RuntimeError(f"the components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links from the larger (or the smaller) neighbours of a node to its smallest, as u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").withColumn("m", F.least("u", "m"))
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()
