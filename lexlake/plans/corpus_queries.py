"""Queries over the parallel corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.functions import text
from lexlake.operators import corpus, dedup, sampling
from lexlake.session import table


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pair").dropDuplicates(["id"])


def dedup_three_level(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.three_levels(_pairs(spark, sf), table(spark, sf, "dictionary"))


def corpus_export(spark: SparkSession, sf: str) -> DataFrame:
    """One pair for each cluster, with the names of the dictionaries that print it."""
    d = table(spark, sf, "dictionary")
    k = dedup.keyed(_pairs(spark, sf), d)
    best = k.groupBy("l").agg(F.min("o").alias("o"), F.collect_set("dictionary_id").alias("ids"))
    named = best.select("l", F.col("o.id").alias("id"), F.explode("ids").alias("dictionary_id")).join(d.select(F.col("id").alias("dictionary_id"), "name"), "dictionary_id")
    names = named.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("name")), "; ").alias("dictionaries"))
    return names.join(_pairs(spark, sf).select("id", "en", "zh"), "id")


def admission(spark: SparkSession, sf: str) -> DataFrame:
    """Which dictionaries are precise enough, and how many records each brings."""
    n = _pairs(spark, sf).groupBy("dictionary_id").agg(F.count("*").alias("n_pairs"))
    return corpus.admitted(table(spark, sf, "dictionary")).join(n, F.col("id") == F.col("dictionary_id"), "left").select("id", "included", "reason", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"))


def source_choice(spark: SparkSession, sf: str) -> DataFrame:
    """For each dictionary the share of its pairs with Chinese on the Chinese side and none on the English."""
    p = _pairs(spark, sf).where("dictionary_id is not null")
    right = ~text.has_cjk(F.col("en")) & text.has_cjk(F.col("zh"))
    g = p.groupBy("dictionary_id").agg(F.count("*").alias("n_pairs"), F.count_if(right).alias("n_right"))
    return g.select("dictionary_id", "n_pairs", "n_right", (F.col("n_right") >= 0.5 * F.col("n_pairs")).alias("keep"))


def pair_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Words, ideographs and kind of each pair, and whether their ratio is that of a translation."""
    return corpus.shapes(_pairs(spark, sf))


def pair_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """How many pairs are usable, and why others aren't."""
    return corpus.verdicts(_pairs(spark, sf)).groupBy("ok", "kind", "reason").agg(F.count("*").alias("n"))


def english_groups(spark: SparkSession, sf: str) -> DataFrame:
    """English sides with several translations."""
    p = _pairs(spark, sf).select(F.md5(text.only_content(F.lower("en"))).alias("g"), F.md5(text.only_content(F.lower("zh"))).alias("z"), "dictionary_id", "id")
    g = p.groupBy("g").agg(F.min("id").alias("first_id"), F.count("*").alias("n_records"), F.count_distinct("z").alias("n_translations"), F.count_distinct("dictionary_id").alias("n_dictionaries"))
    return g.where("n_translations > 1").drop("g")


def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Five pairs of each dictionary, drawn for an audit."""
    return sampling.seeded(_pairs(spark, sf).where("dictionary_id is not null").select("dictionary_id", "id"), "dictionary_id", "id", 5, "audit")


def weighted_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty label rows, the likelier the more senses they cover."""
    rows = table(spark, sf, "label").dropDuplicates(["id"]).select("id", F.col("senses").cast("double").alias("w"))
    return sampling.weighted(rows, "id", "w", 50, "gold").select("id")


def spread_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.spread(_pairs(spark, sf).where("dictionary_id is not null").select("dictionary_id", "id"), "dictionary_id", "id", 4)


def audit_precision(spark: SparkSession, sf: str) -> DataFrame:
    """Precision of each dictionary if every pair with a side in the wrong script is bad and every one without a kind unread."""
    p = _pairs(spark, sf).where("dictionary_id is not null")
    bad = text.has_cjk(F.col("en")) | ~text.has_cjk(F.col("zh"))
    return corpus.precision(p.select(F.col("dictionary_id").alias("source"), bad.alias("bad"), (~bad & F.col("kind").isNull()).alias("pending")))


QUERIES = {
    f.__name__: f
    for f in (dedup_three_level, corpus_export, admission, source_choice, pair_shapes, pair_verdicts, english_groups, seeded_sample, weighted_sample, spread_sample, audit_precision)
}

_P = "p AS (SELECT DISTINCT ON (id) * FROM pair)"
_CJK = "[\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"
_KEYS = f"""{_P}, d AS (SELECT id, name, row_number() OVER (ORDER BY precision DESC NULLS LAST, id) AS priority FROM dictionary),
    k AS (SELECT p.id, p.dictionary_id, coalesce(d.priority, 2147483647) AS priority,
          trim(regexp_replace(lower(p.en), '[\\s\\p{{Z}}]+', ' ', 'g')) || chr(9) || regexp_replace(lower(p.zh), '[\\s\\p{{Z}}]+', '', 'g') AS e,
          regexp_replace(lower(p.en), '[^\\p{{L}}\\p{{N}}]', '', 'g') || chr(9) || regexp_replace(lower(p.zh), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS l,
          regexp_replace(lower(p.en), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS g
          FROM p LEFT JOIN d ON d.id = p.dictionary_id)"""
_RIGHT = f"NOT regexp_matches(en, '{_CJK}') AND regexp_matches(zh, '{_CJK}')"
_SHAPES = f"""x AS (SELECT id, en, zh, len(regexp_extract_all(en, '[A-Za-z]+(?:[''’-][A-Za-z]+)*')) AS words, len(regexp_extract_all(zh, '{_CJK}')) AS chars FROM p)"""

SQL = {
    "dedup_three_level": f"""WITH {_KEYS},
        x AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY priority, id) AS n FROM k),
        s AS (SELECT e, count(DISTINCT dictionary_id) AS sources FROM k GROUP BY e)
        SELECT x.id AS pair_id, first_value(x.id) OVER (PARTITION BY l ORDER BY priority, id) AS cluster, count(*) OVER (PARTITION BY l) AS size,
               count(*) OVER (PARTITION BY g) AS variants, s.sources
        FROM x JOIN s USING (e) WHERE n = 1""",
    "corpus_export": f"""WITH {_KEYS},
        b AS (SELECT l, arg_min(id, {{'a': priority, 'b': id}}) AS id FROM k GROUP BY l),
        n AS (SELECT DISTINCT b.id, d.name FROM k JOIN b USING (l) JOIN d ON d.id = k.dictionary_id)
        SELECT n.id, string_agg(n.name, '; ' ORDER BY n.name) AS dictionaries, any_value(p.en) AS en, any_value(p.zh) AS zh FROM n JOIN p ON p.id = n.id GROUP BY n.id""",
    "admission": f"""WITH {_P}, n AS (SELECT dictionary_id, count(*) AS n FROM p GROUP BY 1)
        SELECT d.id, coalesce(precision >= 0.95, FALSE) AS included, CASE WHEN precision IS NULL THEN 'not audited' WHEN precision < 0.95 THEN 'precision below the minimum' ELSE '' END AS reason,
               coalesce(n.n, 0) AS n_pairs FROM dictionary d LEFT JOIN n ON n.dictionary_id = d.id""",
    "source_choice": f"""WITH {_P}, g AS (SELECT dictionary_id, count(*) AS n_pairs, count(*) FILTER (WHERE {_RIGHT}) AS n_right FROM p WHERE dictionary_id IS NOT NULL GROUP BY 1)
        SELECT dictionary_id, n_pairs, n_right, n_right >= 0.5 * n_pairs AS keep FROM g""",
    "pair_shapes": f"""WITH {_P}, {_SHAPES}
        SELECT id, words, chars, CASE WHEN words >= 4 AND regexp_matches(en, '[.?!…]["''”’)]*\\s*$') THEN 'sentence' ELSE 'phrase' END AS kind,
               words > 0 AND chars >= 0.3 * words AND chars <= 6.0 * words AS plausible FROM x""",
    "english_groups": f"""WITH {_P}, k AS (SELECT id, dictionary_id, regexp_replace(lower(en), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS g, regexp_replace(lower(zh), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS z FROM p)
        SELECT min(id) AS first_id, count(*) AS n_records, count(DISTINCT z) AS n_translations, count(DISTINCT dictionary_id) AS n_dictionaries FROM k GROUP BY g HAVING count(DISTINCT z) > 1""",
    "seeded_sample": f"WITH {_P} SELECT dictionary_id, id FROM p WHERE dictionary_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dictionary_id ORDER BY md5('audit:' || id), id) <= 5",
    "weighted_sample": """WITH l AS (SELECT DISTINCT ON (id) id, CAST(senses AS DOUBLE) AS w FROM label)
        SELECT id FROM l WHERE w > 0 ORDER BY pow((CAST('0x' || md5('gold:' || id)[1:12] AS BIGINT) + 1) / 281474976710658.0, 1.0 / w) DESC, id LIMIT 50""",
    "spread_sample": f"""WITH {_P}, x AS (SELECT dictionary_id, id, row_number() OVER (PARTITION BY dictionary_id ORDER BY id) - 1 AS i, count(*) OVER (PARTITION BY dictionary_id) AS m FROM p WHERE dictionary_id IS NOT NULL)
        SELECT dictionary_id, id FROM x WHERE m <= 4 OR i = ((i * 4 // m) * m + m // 2) // 4""",
    "audit_precision": f"""WITH {_P}, x AS (SELECT dictionary_id AS source, NOT ({_RIGHT}) AS bad, ({_RIGHT}) AND kind IS NULL AS pending FROM p WHERE dictionary_id IS NOT NULL)
        SELECT source, count(*) AS n, count(*) FILTER (WHERE bad) AS bad, count(*) FILTER (WHERE pending) AS pending, 1 - (count(*) FILTER (WHERE bad) + count(*) FILTER (WHERE pending)) / count(*) AS precision FROM x GROUP BY 1""",
}
