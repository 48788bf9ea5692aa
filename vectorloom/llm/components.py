"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; links move towards the smallest
node of their component. The links are written to the shared folder after each
round, so lineage stays short and a lost executor costs one step. Only two sums
of a round reach the driver, to see that nothing changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.session import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (a > b). Large: neighbours above a node go to its smallest neighbour."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    moved = both.join(low, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = moved.select("b", "low").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.unionByName(low.select("a", F.col("low").alias("b")))
    return moved.where("a != b").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of a link; component is its smallest node.

    Links with a null end and links of a node to itself count for nothing;
    repeated links count once. No links give an empty table.
    """
    a, b = F.col(left), F.col(right)
    table = stored(
        links.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        table = stored(_star(_star(table, True), False), "links")
    node = table.select(F.col("a").alias("node"), F.col("b").alias("component"))
    own = table.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return node.unionByName(own)
