"""Samples that don't depend on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.operators.once import numbered


def place(key: Column, seed: str) -> Column:
    """A text that orders keys as if at random, the same on every run."""
    return F.md5(F.concat(F.lit(seed + ":"), key.cast("string")))


def uniform(key: Column, seed: str) -> Column:
    """A number above 0 and below 1 for each key."""
    return (F.conv(F.substring(place(key, seed), 1, 12), 16, 10).cast("double") + 1) / float(16**12 + 2)


def seeded(rows: DataFrame, group: str, key: str, n: int, seed: str) -> DataFrame:
    """n rows of each group, those with the smallest places."""
    w = Window.partitionBy(group).orderBy(place(F.col(key), seed), key)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def weighted(rows: DataFrame, key: str, weight: str, k: int, seed: str) -> DataFrame:
    """k rows without replacement, each the likelier the greater its weight; weights of 0 or less never."""
    score = F.pow(uniform(F.col(key), seed), 1.0 / F.col(weight))
    return rows.where(F.col(weight) > 0).withColumn("score", score).orderBy(F.desc("score"), key).limit(k)


def spread(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """n rows of each group evenly spaced in order, the middle one of each n-th; all of a smaller group."""
    counts = rows.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_m"))
    placed = numbered(rows, [group], order, "_i").withColumn("_i", F.col("_i") - 1)
    both = placed.join(counts, placed[group].eqNullSafe(counts["_g"]))
    part = F.floor(F.col("_i") * n / F.col("_m"))
    middle = F.floor((part * F.col("_m") + F.floor(F.col("_m") / 2)) / n)
    return both.where((F.col("_m") <= n) | (F.col("_i") == middle)).drop("_i", "_m", "_g")
