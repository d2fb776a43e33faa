"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a grouped minimum with map-side combine and an equi-join, so a hub of any degree is never gathered in one
task. Steps are written to shared storage; nothing but two numbers a step comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (u, v) with u > v. Large star: every neighbour above u is linked to the least of u's neighbourhood;
    small star: every neighbour below u, and u itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (undirected, repeated edges and loops allowed); root is the least node of
    the component. Nodes may be of any orderable type. ``rows``: about how many edges, if known."""
    now = stored(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .distinct(), "edges", few=True, rows=rows)
    state = _state(now)
    while state[0]:
        now = stored(_star(_star(now, True), False), "edges", few=True, rows=state[0])
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
