"""Closures and components over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.session import cut_lineage

MAX_HOPS = 5


def redirect_closure(edges: DataFrame, ends: DataFrame, hops: int = MAX_HOPS) -> DataFrame:
    """(dict_id, source, target, hops): the ends that each source reaches in its dictionary, by the shortest chain.

    edges is (dict_id, source, target), ends (dict_id, target) the targets where a chain stops.
    A cycle ends with the number of hops; each hop is one equi join and keeps only new pairs.
    """
    reached = frontier = cut_lineage(edges.withColumn("hops", F.lit(1)))
    step = frontier.select("dict_id", F.col("source").alias("target"), F.col("target").alias("next"))
    for n in range(2, hops + 1):
        going = frontier.join(step, ["dict_id", "target"]).select("dict_id", "source", F.col("next").alias("target")).distinct()
        frontier = cut_lineage(going.join(reached, ["dict_id", "source", "target"], "left_anti").withColumn("hops", F.lit(n)))
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached.join(ends, ["dict_id", "target"], "left_semi").groupBy("dict_id", "source", "target").agg(F.min("hops").alias("hops"))


def components(edges: DataFrame, a: str, b: str, most: int = 50) -> DataFrame:
    """(node, component): connected components, each named by its smallest node.

    Alternates large-star and small-star steps, which halve the distance to the smallest node and
    never hold the neighbours of a node in one place: all a step needs of them is their minimum.
    Lineage is cut after every round; the count of changed edges is all that reaches the driver.
    """
    nodes = edges.select(F.col(a).alias("node")).union(edges.select(F.col(b))).where("node is not null").distinct()
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = cut_lineage(pairs)
    for _ in range(most):
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(down.select("u", F.col("m"))).distinct()
        small = cut_lineage(small)
        same = small.join(pairs, ["u", "v"], "left_anti").isEmpty() and pairs.join(small, ["u", "v"], "left_anti").isEmpty()
        pairs = small
        if same:
            break
    else:
        raise RuntimeError(f"no end after {most} rounds")
    return nodes.join(pairs.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
