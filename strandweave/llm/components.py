"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014).

Each round is two aggregations over the links, stored in the shared folder, so neither links nor
components ever meet in the driver or in one task, and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import join_to_groups, stored, workspace


def _toward_least(links: DataFrame, center: str, leaf: str, keep_larger: bool) -> DataFrame:
    """Link each neighbour (``leaf``) of a node (``center``) to the least node around it."""
    least = links.groupBy(center).agg(
        F.min(leaf).alias("least"), F.count(F.lit(1)).alias("size")
    ).select(center, F.least(center, "least").alias("least"), "size")
    total = links.count()
    out = join_to_groups(links, least, center, "size", total)
    if keep_larger:
        out = out.where(F.col(leaf) > F.col(center)).select(F.col(leaf).alias("u"), F.col("least").alias("v"))
    else:
        own = least.select(F.col(center).alias("u"), F.col("least").alias("v"))
        out = out.select(F.col(leaf).alias("u"), F.col("least").alias("v")).unionByName(own)
    return out.where("u <> v").distinct()


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links``: two long columns u, v. Returns (node, component): the least node reachable.

    Only nodes that have a link appear. Loops and null ends are ignored; no links give no rows.
    The number of rounds is logarithmic in practice; it stops when a round changes nothing.
    """
    spark = links.sparkSession
    folder = workspace(spark, name)
    edges = stored(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        f"{folder}/0",
    )
    step = 0
    before = None
    while True:
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_toward_least(both, "u", "v", True), f"{folder}/{step}-large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = stored(_toward_least(down, "u", "v", False), f"{folder}/{step}-small")
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if (now.n, now.h) == before:
            break
        before = (now.n, now.h)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
