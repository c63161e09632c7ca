"""Queries over phrases, forms, sources and running text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.functions import inflect
from lexlake.functions.closed import ARTICLES
from lexlake.operators import choice, folders, irregulars, phrases, simplified
from lexlake.operators.corpus import CJK
from lexlake.plans.catalog_queries import _L, _latest
from lexlake.plans.dictionary_queries import _S, _senses
from lexlake.session import table

def simplification_map(spark: SparkSession, sf: str) -> DataFrame:
    return simplified.learnt(table(spark, sf, "pair").dropDuplicates(["id"]), "zh", "zh_hans")


def simplified_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """How many Chinese texts equal their simplified ones once the learnt map is applied."""
    both = simplified.mapping(simplification_map(spark, sf))
    rows = table(spark, sf, "pair").dropDuplicates(["id"]).where("zh_hans is not null")
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col("zh") == F.col("zh_hans")).alias("n_same"), F.count_if(simplified.to_simplified(F.col("zh"), both) == F.col("zh_hans")).alias("n_same_simplified"))


def phrase_kinds(spark: SparkSession, sf: str) -> DataFrame:
    s = _senses(spark, sf).where("phrase <> ''")
    return phrases.kinds(s.select(F.lower("phrase").alias("phrase"), F.col("phrase").alias("printed"), F.col("kind").alias("record_kind"), "pos"))


def chosen_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Which dictionaries to read pairs from, and in which order, by their records in either order; every tenth is read by style."""
    p = table(spark, sf, "pair").dropDuplicates(["id"]).where("dictionary_id is not null and en is not null and zh is not null")
    cjk = lambda c: F.regexp_count(c, F.lit(CJK))
    words = lambda c: F.regexp_count(c, F.lit("[A-Za-z]+"))
    rows = p.select(F.col("dictionary_id").alias("id"), (cjk("en") == 0).alias("straight"), F.col("en").rlike(r"[\x{00C0}-\x{024F}]").alias("accented"), words("en").alias("we"), cjk("zh").alias("cz"), words("zh").alias("wz"), cjk("en").alias("ce"))
    fits = lambda c, w: F.when((F.col(w) > 0) & (F.col(c) >= F.col(w)), 1.0).otherwise(0.0)
    probes = rows.groupBy("id").agg(
        F.when(F.count("*") >= 5, "ok").otherwise("unreadable").alias("status"), F.count_if(~F.col("accented")).alias("english"), F.count_if("accented").alias("foreign"),
        F.avg(F.when(F.col("straight"), fits("cz", "we"))).alias("en_zh"), F.count_if("straight").alias("n_en_zh"), F.avg(F.when(~F.col("straight"), fits("ce", "wz"))).alias("zh_en"), F.count_if(~F.col("straight")).alias("n_zh_en"),
    )
    return choice.choose(probes, table(spark, sf, "dictionary").where("id % 10 = 0").select("id", F.lit("styled").alias("extractor")))


def judged_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Forms of every noun and verb as dictionaries might list them: the regular ones, and by every third
    dictionary one with a letter doubled, changed or added, each judged by itself."""
    e = table(spark, sf, "entry").where("lower(headword) rlike '^[a-z]+$'").select("id", F.col("dict_id").alias("dictionary"), F.lower("headword").alias("lemma"))
    s = _senses(spark, sf).where("pos in ('noun', 'verb')").select(F.col("entry_id").alias("id"), "pos").distinct()
    regular = e.join(s, "id").select("dictionary", "lemma", "pos", F.explode(inflect.forms(F.col("lemma"), F.col("pos"))).alias("f")).select("dictionary", "lemma", "pos", "f.slot", "f.form")
    odd = regular.where("dictionary % 3 = 0").withColumn("form", F.when(F.col("slot") == "Plur", F.concat("lemma", F.lit("en"))).when(F.col("dictionary") % 2 == 0, F.concat(F.expr("substr(form, 1, 1)"), "form")).otherwise(F.translate("lemma", "aeiou", "eioua")))
    return irregulars.judged(regular.unionByName(odd)).groupBy("pos", "slot", "kind").agg(F.count("*").alias("forms"), F.sum("n").alias("n"))


def folder_records(spark: SparkSession, sf: str) -> DataFrame:
    """The files of the last listing, grouped into records again."""
    f = _latest(spark, sf).select(F.explode("locations").alias("l")).select("l.folder", F.explode("l.files").alias("f")).select("folder", "f.name", "f.size")
    return folders.records(f).groupBy("kind").agg(F.count("*").alias("n_records"), F.sum("n_files").alias("n_files"), F.sum("size").alias("bytes"))


def document_words(spark: SparkSession, sf: str) -> DataFrame:
    """For each document its words, those that are headwords, and those that have a label."""
    w = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)).alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    known = table(spark, sf, "entry").select(F.lower("headword").alias("word")).distinct().withColumn("known", F.lit(True))
    labelled = table(spark, sf, "label").select(F.lower("word").alias("word")).distinct().withColumn("labelled", F.lit(True))
    g = w.join(known, "word", "left").join(labelled, "word", "left").groupBy("doc_id")
    return g.agg(F.sum("n").alias("words"), F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("known"), F.sum(F.when(F.col("labelled"), F.col("n")).otherwise(0)).alias("labelled"))


QUERIES = {f.__name__: f for f in (simplification_map, simplified_pairs, phrase_kinds, chosen_sources, judged_forms, folder_records, document_words)}

_MAP = """p AS (SELECT DISTINCT ON (id) * FROM pair), c AS (SELECT zh AS a, zh_hans AS b FROM p WHERE zh <> zh_hans AND length(zh) = length(zh_hans)),
    x AS (SELECT a[i] AS p, b[i] AS q FROM (SELECT a, b, unnest(generate_series(1, length(a))) AS i FROM c)),
    v AS (SELECT p, q, count(*) AS n FROM x WHERE regexp_full_match(p, '[㐀-䶿一-鿿]') AND regexp_full_match(q, '[㐀-䶿一-鿿]') GROUP BY 1, 2),
    m AS (SELECT p AS char, arg_min(q, {'a': -n, 'b': q}) AS "to", max(n) AS n FROM v GROUP BY p)"""
SQL = {
    "simplification_map": f"""WITH {_MAP} SELECT * FROM m WHERE char <> "to" AND n >= 2""",
    "simplified_pairs": f"""WITH {_MAP}, k AS (SELECT char, "to" FROM m WHERE char <> "to" AND n >= 2), r AS (SELECT id, zh, zh_hans FROM p WHERE zh_hans IS NOT NULL),
        l AS (SELECT id, string_agg(coalesce("to", c), '' ORDER BY i) AS made FROM (SELECT id, i, zh[i] AS c FROM (SELECT id, zh, unnest(generate_series(1, length(zh))) AS i FROM r)) LEFT JOIN k ON k.char = c GROUP BY id)
        SELECT count(*) AS n, count(*) FILTER (WHERE zh = zh_hans) AS n_same, count(*) FILTER (WHERE coalesce(made, '') = zh_hans) AS n_same_simplified FROM r LEFT JOIN l USING (id)""",
    "phrase_kinds": f"""WITH {_S}, r AS (SELECT lower(phrase) AS phrase, phrase AS printed, kind, lower(coalesce(pos, '')) AS pos FROM s WHERE phrase <> ''),
        x AS (SELECT *, list_filter(regexp_extract_all(printed, '\\p{{L}}[\\p{{L}}\\p{{N}}_''-]*'), lambda z: lower(z) NOT IN {phrases.SMALL_IN_NAMES}) AS big FROM r),
        g AS (SELECT phrase, bool_or(kind = 'phrasal_verb' OR pos LIKE '%phrasal%') AS verb, bool_and(len(big) > 0 AND len(list_filter(big, lambda z: NOT regexp_matches(z, '^\\p{{Lu}}'))) = 0) AS name,
              bool_or(regexp_matches(pos, '{"|".join(phrases.FORMULA)}') OR regexp_matches(printed, '[?!]\\s*$')) AS formula, bool_and(pos IN ('noun', 'n', 'n.')) AS nouns,
              list_aggregate(list_transform(string_split(phrase, ' '), lambda t: CASE WHEN t IN {ARTICLES} THEN 'a' WHEN t = 'of' THEN 'o' WHEN t = 'and' THEN 'c' WHEN t LIKE '{{%' OR t IN {phrases.CLOSED} THEN 'x' ELSE 'n' END), 'string_agg', '') AS shape
              FROM x GROUP BY phrase)
        SELECT phrase, CASE WHEN verb THEN 'phrasal_verb' WHEN name THEN 'name' WHEN formula THEN 'formula' WHEN nouns AND regexp_matches(shape, '{phrases.NOUN_PHRASE}') THEN 'compound' ELSE 'idiom' END AS kind FROM g""",
    "chosen_sources": f"""WITH x AS (SELECT dictionary_id AS id, len(regexp_extract_all(en, '{CJK}')) AS ce, len(regexp_extract_all(zh, '{CJK}')) AS cz, len(regexp_extract_all(en, '[A-Za-z]+')) AS we, len(regexp_extract_all(zh, '[A-Za-z]+')) AS wz,
            regexp_matches(en, '[\\x{{00C0}}-\\x{{024F}}]') AS accented FROM (SELECT DISTINCT ON (id) * FROM pair) WHERE dictionary_id IS NOT NULL AND en IS NOT NULL AND zh IS NOT NULL),
        p AS (SELECT id, CASE WHEN count(*) >= 5 THEN 'ok' ELSE 'unreadable' END AS status, count(*) FILTER (WHERE NOT accented) AS english, count(*) AS every, count(*) FILTER (WHERE ce = 0) AS n1, count(*) FILTER (WHERE ce > 0) AS n2,
            coalesce(avg(CASE WHEN we > 0 AND cz >= we THEN 1.0 ELSE 0.0 END) FILTER (WHERE ce = 0), 0) AS m1, coalesce(avg(CASE WHEN wz > 0 AND ce >= wz THEN 1.0 ELSE 0.0 END) FILTER (WHERE ce > 0), 0) AS m2 FROM x GROUP BY id),
        q AS (SELECT *, n1 >= 5 AND m1 - 0.5 / sqrt(greatest(n1, 1)) >= 0.3 AS ok1, n2 >= 5 AND m2 - 0.5 / sqrt(greatest(n2, 1)) >= 0.3 AS ok2, id % 10 = 0 AND EXISTS (SELECT 1 FROM dictionary d WHERE d.id = p.id) AS styled FROM p),
        r AS (SELECT *, {{'a': ok1, 'b': m1, 'c': n1, 'd': 1}} >= {{'a': ok2, 'b': m2, 'c': n2, 'd': 0}} AS straight FROM q),
        s AS (SELECT *, CASE WHEN status <> 'ok' THEN status WHEN english < 0.5 * every THEN 'mostly another language' WHEN CASE WHEN straight THEN n1 ELSE n2 END < 5 THEN 'too few scored pairs'
            WHEN NOT CASE WHEN straight THEN ok1 ELSE ok2 END THEN 'not clearly translations' ELSE '' END AS reason FROM r)
        SELECT id, reason = '' OR styled AND status = 'ok' AS keep, CASE WHEN straight THEN 'en-zh' ELSE 'zh-en' END AS reading, CASE WHEN styled AND status = 'ok' THEN 'styled' ELSE 'text' END AS extractor, reason FROM s""",
    "document_words": """WITH w AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY 1, 2)
        SELECT doc_id, CAST(sum(n) AS BIGINT) AS words, CAST(sum(CASE WHEN word IN (SELECT lower(headword) FROM entry) THEN n ELSE 0 END) AS BIGINT) AS known,
               CAST(sum(CASE WHEN word IN (SELECT lower(word) FROM label) THEN n ELSE 0 END) AS BIGINT) AS labelled FROM w GROUP BY doc_id""",
}
