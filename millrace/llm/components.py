"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import dropped, saved


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): one root per component.

    Each round maps every node to its neighbour (or itself) of smallest hash under the
    round's seed, and contracts the edges; hashed priorities shrink chains and stars alike,
    so rounds grow with the logarithm of the edges. Only "is anything left" comes to the
    driver. A hub's edges are pre-aggregated before they are shuffled. No edges: no rows.
    """
    edges = saved(edges.select("a", "b").where("a <> b"), label)
    maps = []
    while not edges.isEmpty():
        seed = F.lit(len(maps))
        rank = lambda c: F.xxhash64(seed, c)  # noqa: E731,B023
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min(F.struct(rank(F.col("b")).alias("h"), F.col("b").alias("x"))).alias("m"))
        to = F.when(F.struct(rank(F.col("a")).alias("h"), F.col("a").alias("x")) < F.col("m"), F.col("a")).otherwise(F.col("m.x"))
        moved = saved(least.select(F.col("a").alias("node"), to.alias("to")), label)
        maps.append(moved)
        first = moved.select(F.col("node").alias("a"), F.col("to").alias("na"))
        second = moved.select(F.col("node").alias("b"), F.col("to").alias("nb"))
        past = edges
        edges = edges.join(first, "a").join(second, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
        edges = saved(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), label)
        dropped(past)
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = maps[0].withColumnRenamed("to", "root")
    for moved in maps[1:]:
        step = moved.select(F.col("node").alias("root"), "to")
        found = found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    found = saved(found, label)
    dropped(*maps)
    return found
