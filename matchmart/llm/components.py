"""Connected components of a link table by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.workspace import Workspace


def components(links: DataFrame, space: Workspace) -> DataFrame:
    """(doc, component) for every node of the links ``(a, b)``; a component is named by its smallest node.

    Steps alternate until nothing changes; only a count and a checksum come to
    the driver. Links of a node are reduced to their minimum before they move,
    and the joins that follow may be split by adaptive execution, so a hub does
    not land in one task whole.
    """
    edges = space.freeze(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = space.freeze(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "min")
        large = space.freeze(both.where(F.col("v") > F.col("u")).join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = space.freeze(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = space.freeze(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    own = edges.select(F.col("v").alias("doc"), F.col("v").alias("component")).distinct()
    return space.freeze(edges.select(F.col("u").alias("doc"), F.col("v").alias("component")).union(own), "components")
