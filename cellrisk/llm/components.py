"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import release, store


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over directed pairs (u, v).

    Large star: each u hands its smallest neighbour (or itself) to its larger neighbours. Small star: each u
    hands the smallest to its smaller neighbours and keeps it for itself. The smallest of a neighbourhood is
    an aggregate that combines map-side, and is joined back, so no neighbourhood is gathered in one place.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = near.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
    return moved.where("u != v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, root) for every node of `links`; root is the smallest node that its links reach.

    Rounds go on until a round changes nothing: O(log^2 n) of them, two or three for star-like links. Nodes
    without links are absent. Links with a null end and links of a node with itself are ignored.
    """
    edges = store(
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u != v").distinct(),
        "links",
    )
    seen = None
    while True:
        after = store(_step(_step(edges, True), False), "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        release(edges)
        if mark == seen:
            break
        edges, seen = after, mark
    roots = after.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
