"""Lookup queries for whole tables of questions at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.operators.search import containing

#: Rows of hits that count for one question, and headwords that come out.
HITS, ANSWERS = 5000, 40


def first_of_each(rows: DataFrame, parent: str, order: list[str], value: str, k: int) -> DataFrame:
    """(parent, total, firsts): how many rows each parent has, and its first k values as one text.

    Spark keeps at most k rows of a parent in each task before the shuffle.
    """
    n = F.row_number().over(Window.partitionBy(parent).orderBy(*order))
    kept = rows.select(parent, F.coalesce(value, F.lit("")).alias("v"), n.alias("n")).where(F.col("n") <= k)
    firsts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "v"))), lambda x: x["v"]), " | ")
    total = rows.groupBy(parent).agg(F.count("*").alias("total"))
    return kept.groupBy(parent).agg(firsts.alias("firsts")).join(total, parent)


def by_gloss(queries: DataFrame, terms: DataFrame, senses: DataFrame, entries: DataFrame, hits: int = HITS, answers: int = ANSWERS) -> DataFrame:
    """(query_id, word, exact, dictionaries, rank): headwords whose gloss is or contains the query.

    queries is (query_id, query), terms (sense_id, term), senses (sense_id, entry_id, dict_id),
    entries (entry_id, headword). Queries and terms meet in equi joins over n-grams.
    """
    found = queries.join(containing(terms, queries, empty=True), "query").join(terms, "term").withColumn("exact", F.col("term") == F.col("query"))
    n = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("exact").desc(), F.length("term"), "term", "sense_id"))
    best = found.withColumn("n", n).where(F.col("n") <= hits)
    rows = best.join(senses, "sense_id").join(entries, "entry_id")
    groups = rows.groupBy("query_id", F.lower("headword").alias("word")).agg(
        F.count_distinct(F.when(F.col("exact"), F.col("dict_id"))).alias("exact"), F.count_distinct("dict_id").alias("dictionaries")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("exact"), F.desc("dictionaries"), F.length("word"), "word"))
    return groups.withColumn("rank", rank).where(F.col("rank") <= answers)


def direct_or_redirected(queries: DataFrame, entries: DataFrame, closure: DataFrame) -> DataFrame:
    """(query, dict_id, entry_id, hops): entries of each dictionary, through redirects only where it has none itself.

    queries is (query), entries (entry_id, dict_id, norm), closure (dict_id, source, target, hops).
    """
    direct = queries.join(entries, queries["query"] == entries["norm"]).select("query", "dict_id", "entry_id", F.lit(0).alias("hops"))
    rest = closure.join(queries, closure["source"] == queries["query"]).join(direct.select("query", "dict_id").distinct(), ["query", "dict_id"], "left_anti")
    ends = entries.select("entry_id", F.col("dict_id"), F.col("norm").alias("target"))
    return direct.unionByName(rest.join(ends, ["dict_id", "target"]).groupBy("query", "dict_id", "entry_id").agg(F.min("hops").alias("hops")))
