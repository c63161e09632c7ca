"""Problem 5: the best representative of each group of duplicate records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands for "nothing" when it is all that a field holds.
NOTHING = ("", "null", "none", "nil", "nan", "n/a", "na", "n.a.", "unknown", "undefined", "无", "暂无")
FIELDS = ("zh_hans", "kind", "headword")


def has_value(c: Column) -> Column:
    """Whether a text holds more than white space, punctuation or a word for nothing."""
    bare = F.lower(F.regexp_replace(c, r"^[\s\p{Z}\p{Cf}\x00-\x1f]+|[\s\p{Z}\p{Cf}\x00-\x1f]+$", ""))
    return c.isNotNull() & ~bare.isin(*NOTHING) & bare.rlike(r"[\p{L}\p{N}]")


def precedence(precision: Column, sources: Column, updated: Column, row_id: Column) -> Column:
    """Sorts first the highest precision, then most sources, then latest; missing last; then smallest id."""
    return F.struct(
        precision.isNull().alias("p0"), (-precision).alias("p"), sources.isNull().alias("s0"), (-sources).alias("s"), updated.isNull().alias("u0"), (-F.unix_micros(updated)).alias("u"), row_id.alias("id")
    )


def survivors(pairs: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """(cluster, field, pair_id): for each cluster with two ids or more where each field comes from.

    zh_hans, kind and headword come from the first member in order of precedence that has a
    value; a field without any gives no row. The representative is the member with most of the
    three values. All of it is one aggregation with map-side partial results, so a cluster with a
    third of all rows costs no more than another. Null clusters and ids count as no members, a
    member delivered again as one. The dictionary table is as small as the number of
    dictionaries; Spark broadcasts it only under its own size threshold.
    """
    d = dictionaries.groupBy(F.col("id").alias("dictionary_id")).agg(F.max("precision").alias("precision"))
    rows = pairs.select("cluster", "id", "sources", "updated_at", "dictionary_id", *(has_value(F.col(f)).alias(f"has_{f}") for f in FIELDS)).where("cluster is not null and id is not null")
    rows = rows.join(d, "dictionary_id", "left")
    order = precedence(F.col("precision"), F.col("sources").cast("int"), F.col("updated_at"), F.col("id"))
    full = sum(F.col(f"has_{f}").cast("int") for f in FIELDS)
    rows = rows.select("cluster", "id", order.alias("o"), full.alias("n"), *(f"has_{f}" for f in FIELDS))
    best = rows.groupBy("cluster").agg(
        F.min("id").alias("least"), F.max("id").alias("most"),
        F.min(F.struct((-F.col("n")).alias("n"), "o"))["o"]["id"].alias("representative"),
        *(F.min(F.when(F.col(f"has_{f}"), F.col("o")))["id"].alias(f) for f in FIELDS),
    ).where("least <> most")
    each = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("pair_id")) for f in (*FIELDS, "representative")))
    return best.select("cluster", F.explode(each).alias("x")).select("cluster", "x.field", "x.pair_id").where("pair_id is not null")
