"""Full-text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.functions import text
from lexlake.functions.stem import stem_list
from lexlake.operators import search
from lexlake.plans.dictionary_queries import _S, _TERMS, _senses, zh_terms
from lexlake.session import table


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "entry").select(F.lower("headword").alias("word")).distinct()


def _misspelt(spark: SparkSession, sf: str) -> DataFrame:
    """Headwords of ids divisible by 100 without their third letter."""
    w = F.lower("headword")
    return table(spark, sf, "entry").where("id % 100 = 0").select(F.concat(F.substring(w, 1, 2), F.substr(w, F.lit(4))).alias("query")).distinct()


def trigram_index(spark: SparkSession, sf: str) -> DataFrame:
    """How many headwords hold each trigram."""
    return search.gram_index(_words(spark, sf), "word").groupBy("gram").agg(F.count("*").alias("df"))


def trigram_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """For every hundredth headword, misspelt, the headwords that share at least three trigrams."""
    q = _misspelt(spark, sf)
    w = q.select("query", F.explode(search.grams(F.col("query"))).alias("gram")).join(search.gram_index(_words(spark, sf), "word"), "gram")
    return w.groupBy("query", "word").agg(F.count("*").alias("shared")).where("shared >= 3")


def suggestions(spark: SparkSession, sf: str) -> DataFrame:
    """For every hundredth headword, misspelt, the headwords most like it."""
    words, q = _words(spark, sf), _misspelt(spark, sf)
    short = search.short_suggestions(words, q).withColumn("ratio", text.ratio("query", "word"))
    return search.similar(search.gram_index(words, "word"), q).unionByName(short)


def _asked(spark: SparkSession, sf: str) -> DataFrame:
    """The senses whose id is divisible by 100."""
    return _senses(spark, sf).where("id % 100 = 0")


def contains_terms(spark: SparkSession, sf: str) -> DataFrame:
    """For three characters, and for two, of the glosses of every hundredth sense the terms that contain them."""
    own = zh_terms(spark, sf).where("sense_id % 100 = 0")
    q = own.select(F.explode(F.array(F.substring("term", 2, 3), F.substring("term", 1, 2))).alias("query")).where("query <> ''").distinct()
    return search.containing(zh_terms(spark, sf).select("term"), q)


def define_words(spark: SparkSession, sf: str) -> DataFrame:
    """Definitions with the first two long words of every hundredth definition, by BM25 over words as they stand."""
    words = F.slice(F.regexp_extract_all(F.lower("definition"), F.lit("([a-z0-9]{5,})"), 1), 1, 2)
    q = _asked(spark, sf).select(F.col("id").alias("query_id"), F.explode(words).alias("term")).distinct()
    return search.define(search.word_lists(_senses(spark, sf), "id", "definition", stemmed=False), q)


def define_stems(spark: SparkSession, sf: str) -> DataFrame:
    """The same over stems."""
    words = F.array_join(F.slice(F.regexp_extract_all(F.lower("definition"), F.lit("([a-z]{5,})"), 1), 1, 2), " ")
    q = _asked(spark, sf).select(F.col("id").alias("query_id"), words.alias("query")).select("query_id", F.explode(stem_list("query")).alias("term"))
    return search.define(search.word_lists(_senses(spark, sf), "id", "definition"), q)


def phrase_attested(spark: SparkSession, sf: str) -> DataFrame:
    """Which phrases of senses stand in the English of the pairs."""
    return search.attested(_senses(spark, sf), table(spark, sf, "pair"), "phrase", "en")


def text_words(spark: SparkSession, sf: str) -> DataFrame:
    """How often each English word stands in the documents, and in how many."""
    index = search.word_index(table(spark, sf, "documents"), "doc_id", "text", stemmed=False)
    return index.groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))


QUERIES = {f.__name__: f for f in (trigram_index, trigram_overlap, suggestions, contains_terms, define_words, define_stems, phrase_attested, text_words)}

_GRAMS = "g AS (SELECT DISTINCT word, word[i : i + 2] AS gram FROM (SELECT word, unnest(generate_series(1, length(word) - 2)) AS i FROM (SELECT DISTINCT lower(headword) AS word FROM entry)))"
_INDEX = f"""{_S}, w AS (SELECT id AS doc_id, regexp_extract_all(lower(definition), '[a-z0-9]+') AS w FROM s WHERE definition IS NOT NULL),
    i AS (SELECT doc_id, len(w) AS length, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM w) GROUP BY ALL)"""

SQL = {
    "trigram_index": f"WITH {_GRAMS} SELECT gram, count(*) AS df FROM g GROUP BY gram",
    "trigram_overlap": f"""WITH {_GRAMS}, q AS (SELECT DISTINCT lower(headword)[1:2] || lower(headword)[4:] AS query FROM entry WHERE id % 100 = 0),
        x AS (SELECT DISTINCT query, query[i : i + 2] AS gram FROM (SELECT query, unnest(generate_series(1, length(query) - 2)) AS i FROM q))
        SELECT query, word, count(*) AS shared FROM x JOIN g USING (gram) GROUP BY 1, 2 HAVING count(*) >= 3""",
    "contains_terms": f"""WITH {_S}, {_TERMS}, q AS (SELECT DISTINCT query FROM (SELECT unnest([term[2:4], term[1:2]]) AS query FROM t WHERE sense_id % 100 = 0) WHERE query <> '')
        SELECT DISTINCT query, term FROM t JOIN q ON contains(term, query)""",
    "define_words": f"""WITH {_INDEX}, q AS (SELECT DISTINCT id AS query_id, unnest(regexp_extract_all(lower(definition), '[a-z0-9]{{5,}}')[1:2]) AS term FROM s WHERE id % 100 = 0),
        n AS (SELECT count(*) AS n_docs, avg(length) AS mean FROM (SELECT DISTINCT doc_id, length FROM i)), df AS (SELECT term, count(*) AS df FROM i GROUP BY term),
        k AS (SELECT query_id, count(*) AS wanted FROM q GROUP BY 1),
        h AS (SELECT query_id, doc_id, count(*) AS n, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
              FROM q JOIN i USING (term) JOIN df USING (term) CROSS JOIN n GROUP BY 1, 2)
        SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM h JOIN k USING (query_id) WHERE n = wanted QUALIFY rank <= 50""",
    "phrase_attested": """WITH p AS (SELECT DISTINCT phrase FROM s_sense WHERE phrase <> ''), w AS (SELECT phrase, regexp_extract_all(lower(phrase), '[a-z0-9]+') AS w FROM p),
        r AS (SELECT phrase, unnest(CASE WHEN len(w) < 2 THEN [] WHEN len(w) <= 4 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i : i + 3], ' '))) END) AS run FROM w),
        t AS (SELECT regexp_extract_all(lower(en), '[a-z0-9]+') AS w FROM pair),
        x AS (SELECT DISTINCT array_to_string(w[i : i + n - 1], ' ') AS run FROM (SELECT w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM t CROSS JOIN (VALUES (2), (3), (4)) v(n))),
        g AS (SELECT p.phrase, count(r.run) AS windows, count(x.run) AS found FROM p LEFT JOIN r ON r.phrase = p.phrase LEFT JOIN x ON x.run = r.run GROUP BY 1)
        SELECT phrase, windows, found, CASE WHEN windows > 0 THEN found = windows END AS attested FROM g""",
    "text_words": """WITH i AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) GROUP BY 1, 2)
        SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM i GROUP BY 1""",
}
