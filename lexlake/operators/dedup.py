"""Three levels of duplicates in a parallel corpus: pairs, clusters, groups of one English side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.functions.text import exact_key, loose_key, only_content


def source_priority(dictionaries: DataFrame) -> DataFrame:
    """(dictionary_id, priority): dictionaries by audited precision, best first, unaudited last, then id."""
    place = F.row_number().over(Window.orderBy(F.col("precision").desc_nulls_last(), "id"))  # as many rows as dictionaries
    return dictionaries.select(F.col("id").alias("dictionary_id"), place.alias("priority"))


def keyed(pairs: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """(id, dictionary_id, en, zh, e, l, g, o): digests of the exact, loose and English keys, and the order."""
    p = pairs.where("en is not null and zh is not null").join(source_priority(dictionaries), "dictionary_id", "left")
    en, zh = F.col("en"), F.col("zh")
    return p.select(
        "id", "dictionary_id", F.md5(exact_key(en, zh)).alias("e"), F.md5(loose_key(en, zh)).alias("l"), F.md5(only_content(F.lower(en))).alias("g"),
        F.struct(F.coalesce("priority", F.lit(2**31 - 1)).alias("p"), F.col("id").alias("id")).alias("o"),
    )


def three_levels(pairs: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """(pair_id, cluster, size, variants, sources): one row for each different pair.

    The record of the dictionary with the best priority gives a pair its text; pairs equal in
    letters and digits form a cluster named by its first pair; variants counts the pairs with one
    English side, sources the dictionaries of a pair. Each level is an aggregation with map-side
    partial results joined back on its key, so repeated records shrink before they are shuffled.
    """
    k = keyed(pairs, dictionaries)
    exact = k.groupBy("e").agg(F.min(F.struct("o", "l", "g")).alias("first"), F.count_distinct("dictionary_id").alias("sources"))
    exact = exact.select(F.col("first.o").alias("o"), F.col("first.l").alias("l"), F.col("first.g").alias("g"), "sources")
    loose = exact.groupBy("l").agg(F.min("o").alias("c"), F.count("*").alias("size"))
    english = exact.groupBy("g").agg(F.count("*").alias("variants"))
    return exact.join(loose, "l").join(english, "g").select(F.col("o.id").alias("pair_id"), F.col("c.id").alias("cluster"), "size", "variants", "sources")
