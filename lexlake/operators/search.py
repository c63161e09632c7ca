"""Full-text indexes as tables: character n-grams, words with counts, word runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.functions import text
from lexlake.functions.stem import stem_list
from lexlake.session import cut_lineage

#: Answers of a suggestion, and the least similarity.
SUGGESTIONS, SIMILAR = 20, 0.75
K1, B = 1.2, 0.75
DEFINED = 50
#: A word is frequent if more than one text in so many holds it; there are at most this times the mean words of a text of them.
OFTEN = 200


def grams(c: Column, n: int = 3) -> Column:
    """The different character n-grams of a text, in order; none of a shorter text."""
    every = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substr(c, i, F.lit(n)))
    return F.array_distinct(F.filter(every, lambda g: F.length(g) == n))


def gram_index(words: DataFrame, word: str, n: int = 3) -> DataFrame:
    """(gram, word) for every different word."""
    return words.select(F.col(word).alias("word")).distinct().select("word", F.explode(grams(F.col("word"), n)).alias("gram"))


def similar(index: DataFrame, queries: DataFrame, k: int = SUGGESTIONS) -> DataFrame:
    """(query, word, ratio, rank): words close to each query, misspelt ones too.

    Words that share a trigram with the query and whose length lets them be similar enough meet in
    an equi join; of all of them the edit similarity decides.
    """
    q = queries.select("query", F.explode(grams(F.col("query"))).alias("gram"))
    possible = 2.0 * F.least(F.length("query"), F.length("word")) >= SIMILAR * (F.length("query") + F.length("word")) - 1e-9
    near = q.join(index, "gram").where(possible).select("query", "word").distinct()
    scored = near.withColumn("ratio", text.ratio_from(F.col("query"), F.col("word"), SIMILAR)).where(F.col("ratio").isNotNull())
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("ratio"), "word"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "word", "ratio", "rank")


def short_suggestions(words: DataFrame, queries: DataFrame, k: int = SUGGESTIONS) -> DataFrame:
    """(query, word): for queries of one or two letters words that begin with them or are one edit away."""
    q = queries.where(F.length("query") <= 2).select("query", text.edits1("query").alias("edits"))
    w = words.select("word").distinct()
    near = q.select("query", F.explode("edits").alias("word")).join(w, "word").select("query", "word")
    begun = w.select("word", F.explode(F.array(F.substring("word", 1, 1), F.substring("word", 1, 2))).alias("query")).join(q.select("query"), "query").select("query", "word")
    scored = near.union(begun).distinct().withColumn("ratio", text.ratio("query", "word"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("ratio"), "word"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "word", "rank")


def containing(terms: DataFrame, queries: DataFrame, n: int = 3, empty: bool = False) -> DataFrame:
    """(query, term): terms that contain the query; the empty query stands in none, or with empty in all.

    A query of n characters or more first meets only the terms that hold its rarest n-gram; a shorter
    one is itself an n-gram of the terms that hold it.
    """
    index = gram_index(terms, "term", n)
    asked = queries.select("query").distinct()
    long = asked.where(F.length("query") >= n).select("query", F.explode(grams(F.col("query"), n)).alias("gram"))
    counts = index.join(long.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("df"))
    rarest = long.join(counts, "gram", "left").groupBy("query").agg(F.min(F.struct(F.coalesce("df", F.lit(0)), "gram"))["gram"].alias("gram"))
    found = rarest.join(index, "gram").where(F.col("word").contains(F.col("query"))).select("query", F.col("word").alias("term"))
    short = asked.where((F.length("query") < n) & (F.lit(empty) | (F.col("query") != "")))
    parts = F.concat(F.array(F.lit("")), *(grams(F.col("term"), m) for m in range(1, n)))
    rest = terms.select("term").distinct().where("term is not null").select("term", F.explode(parts).alias("query")).join(short, "query").select("query", "term")
    return found.unionByName(rest)


def word_lists(docs: DataFrame, doc_id: str, body: str, stemmed: bool = True) -> DataFrame:
    """(doc_id, w): the words of each text in order, stemmed or as they stand."""
    words = stem_list(F.col(body)) if stemmed else F.regexp_extract_all(F.lower(body), F.lit("([a-z0-9]+)"), 1)
    return docs.select(F.col(doc_id).alias("doc_id"), words.alias("w")).where("w is not null")


def word_index(docs: DataFrame, doc_id: str, body: str, stemmed: bool = True) -> DataFrame:
    """(doc_id, term, tf, length): words of each text with their counts, stemmed or as they stand."""
    listed = word_lists(docs, doc_id, body, stemmed)
    return listed.select("doc_id", F.size("w").alias("length"), F.explode("w").alias("term")).groupBy("doc_id", "length", "term").agg(F.count("*").alias("tf"))


def define(lists: DataFrame, queries: DataFrame, k: int = DEFINED) -> DataFrame:
    """(query_id, doc_id, score, rank): texts that hold all words of a query, best by BM25.

    lists is (doc_id, w) of word_lists, each text once, queries (query_id, term). The lists are
    written once and read from there. Queries of the same words are answered once. Only the texts
    that hold a query's rarest word are read for its other words; words that many texts hold, of
    which there can be few, leave the index first, unless they are a query's rarest. Joins with the
    index and the lists are merges: Spark takes their size for that of the table before its texts
    are split, and would send all of them to the driver.
    """
    listed = cut_lineage(lists.where(F.size("w") > 0).select("doc_id", F.array_join("w", " ").alias("text"))).select("doc_id", F.split("text", " ").alias("w"))
    index = listed.select("doc_id", F.explode(F.array_distinct("w")).alias("term"))
    size = listed.agg(F.count("*").alias("n_docs"), F.avg(F.size("w")).alias("mean"))  # one row
    asked = queries.groupBy("query_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    df = index.groupBy("term").agg(F.count("*").alias("df"))
    # a word that stands nowhere leaves its query without an answer
    each = asked.select("terms").distinct().select("terms", F.explode("terms").alias("term")).join(df.hint("merge"), "term")
    parts = F.sort_array(F.collect_list(F.struct("df", "term")))
    weighed = each.groupBy("terms").agg(parts.alias("parts")).where(F.size("parts") == F.size("terms")).withColumn("term", F.col("parts")[0]["term"])
    often = df.crossJoin(F.broadcast(size)).where(F.col("df") * OFTEN > F.col("n_docs")).select("term").join(weighed.select("term"), "term", "left_anti")
    texts = weighed.hint("merge").join(index.join(F.broadcast(often), "term", "left_anti"), "term").select("terms", "parts", "doc_id")
    hits = texts.join(listed.hint("merge"), "doc_id").where(F.size(F.array_except("terms", "w")) == 0).crossJoin(F.broadcast(size))

    def part(p: Column) -> Column:
        tf, length = F.size("w") - F.size(F.array_remove("w", p["term"])), F.size("w")
        idf = F.log(1 + (F.col("n_docs") - p["df"] + 0.5) / (p["df"] + 0.5))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.col("mean")))

    scored = hits.select("terms", "doc_id", F.round(F.aggregate("parts", F.lit(0.0), lambda total, p: total + part(p)), 6).alias("score"))
    rank = F.row_number().over(Window.partitionBy("terms").orderBy(F.desc("score"), "doc_id"))
    best = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    return asked.join(best, "terms").select("query_id", "doc_id", "score", "rank")


def runs(words: Column, least: int, most: int) -> Column:
    """All runs of least to most neighbouring words, as texts."""

    def of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1))), lambda i: F.when(F.size(words) >= n, F.array_join(F.slice(words, i, n), " ")))

    return F.array_distinct(F.array_compact(F.concat(*(of(n) for n in range(least, most + 1)))))


def attested(phrases: DataFrame, docs: DataFrame, phrase: str, body: str, most: int = 4) -> DataFrame:
    """(phrase, windows, found, attested): whether all windows of most words of a phrase stand in the texts.

    A phrase of two to most words is its own window; one word has none and its answer is null.
    """
    words = F.regexp_extract_all(F.lower(F.col(phrase)), F.lit("([a-z0-9]+)"), 1)
    p = phrases.select(F.col(phrase).alias("phrase")).where("phrase <> ''").distinct()
    listed = p.select("phrase", F.regexp_extract_all(F.lower("phrase"), F.lit("([a-z0-9]+)"), 1).alias("w"))
    window = F.when(F.size("w") < 2, F.array().cast("array<string>")).when(F.size("w") <= most, F.array(F.array_join("w", " "))).otherwise(runs(F.col("w"), most, most))
    wanted = listed.select("phrase", F.explode_outer(window).alias("run"))
    texts = docs.select(F.regexp_extract_all(F.lower(body), F.lit("([a-z0-9]+)"), 1).alias("w"))
    shingles = texts.select(F.explode(runs(F.col("w"), 2, most)).alias("run")).join(wanted.select("run").where("run is not null").distinct(), "run", "left_semi").distinct()
    hit = wanted.join(shingles.withColumn("hit", F.lit(True)), "run", "left")
    g = hit.groupBy("phrase").agg(F.count("run").alias("windows"), F.count("hit").alias("found"))
    return g.withColumn("attested", F.when(F.col("windows") > 0, F.col("found") == F.col("windows")))
