"""The queries of problems 2 to 9, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.llm import canonical, copies, fusion, language, leakage, lookalike, mixing, splitting, truth
from lexlake.session import table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    values = canonical.typed_values(table(spark, sf, "s_sense"), table(spark, sf, "label"))
    return canonical.mapped(values, table(spark, sf, "label_item"))


def p2_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """How often each field has values that mean no item."""
    return p2_found(spark, sf).groupBy("field").agg(F.count("*").alias("n_values"), F.count_if(F.col("item_id") == canonical.MISS).alias("n_unmatched"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return language.found(table(spark, sf, "documents"), table(spark, sf, "pair"), table(spark, sf, "record_snapshot"))


def p3_segments(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "pair")
    model = language.fit_languages(table(spark, sf, "documents"), [(pairs, "en", "en"), (pairs, "zh", "zh")])
    return language.document_segments(table(spark, sf, "documents"), model)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return copies.copies(table(spark, sf, "pair"), "id", "en", "zh")


def p4_records(spark: SparkSession, sf: str) -> DataFrame:
    return copies.collapsed(table(spark, sf, "pair"), "id", "en", "zh")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return fusion.survivors(table(spark, sf, "pair"), table(spark, sf, "dictionary"))


def p5_fused(spark: SparkSession, sf: str) -> DataFrame:
    return truth.fused(table(spark, sf, "pair"), table(spark, sf, "dictionary"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    pair = lookalike.look_alike_columns(table(spark, sf, "pair"), "id", "zh", "zh_hans")
    return lookalike.look_alike_rows(table(spark, sf, "entry"), "dict_id", "id", "headword").select(F.lit("entry").alias("tbl"), "id_a", "id_b").unionByName(
        pair.select(F.lit("pair").alias("tbl"), F.col("id").alias("id_a"), F.col("id").alias("id_b"))
    )


def p6_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Every headword and every text of pair in the one form."""
    entry = lookalike.one_form(table(spark, sf, "entry").select("id", "headword", "norm"), headword="headword", norm="norm")
    pair = lookalike.one_form(table(spark, sf, "pair").select("id", "zh", "zh_hans"), zh="zh", zh_hans="zh_hans")
    return entry.select(F.lit("entry").alias("tbl"), "id", F.col("headword").alias("text"), F.col("norm").alias("other")).unionAll(pair.select(F.lit("pair"), "id", "zh", "zh_hans")).distinct()


def p6_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The spellings of each headword of a dictionary that look the same."""
    return lookalike.look_alike_classes(table(spark, sf, "entry"), "dict_id", "id", "headword").withColumnRenamed("g", "dict_id")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_item")).select("doc_id", "item_id")


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    sample, _ = mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_target"))
    return sample.select("doc_id", "leaf.source", "n_tokens", "copies")


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(*mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_target")))


def p8_quotas(spark: SparkSession, sf: str) -> DataFrame:
    """What each source is to give, in characters, if twice the characters that there are were asked for."""
    rows = table(spark, sf, "documents").where("doc_id is not null and text <> ''").select("doc_id", F.struct(F.coalesce("source", F.lit("")).alias("source")).alias("leaf"), F.length("text").cast("long").alias("n_tokens"), F.sha2("text", 256).alias("t"))
    sized = rows.groupBy("t").agg(F.min(F.struct("doc_id", "leaf", "n_tokens")).alias("r")).select("r.leaf", "r.n_tokens")
    asked = 2 * (sized.agg(F.sum("n_tokens")).first()[0] or 0)
    made = mixing.plan(sized, table(spark, sf, "mix_target"), ("source",), "target_share", "max_repeats", asked)
    return spark.createDataFrame([(*x.path, x.size, int(round(x.quota))) for x in made.leaves], "source string, available long, planned long")


#: Languages of the tree of p8_tree with their weights; other and missing labels make one more.
LANGUAGES = {"en": 0.4, "zh": 0.3, "de": 0.05, "fr": 0.05, "es": 0.05, "it": 0.04, "nl": 0.04, "ja": 0.04, "ru": 0.03}


def p8_tree(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a mixture down a tree of domains, languages and sources."""
    domain = F.when(F.col("source").isin("reading_text", "learner_forum", "example_set"), "texts").otherwise("reference").alias("domain")
    targets = table(spark, sf, "mix_target").select(
        domain, F.explode(F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))).alias("language", "part"), "source", "target_share", "max_repeats"
    )
    targets = targets.withColumn("target_share", F.col("target_share") * F.col("part")).drop("part")
    rows = table(spark, sf, "documents").select("doc_id", "text", domain, language.label_code(F.col("lang")).alias("language"), "source")
    path = ("domain", "language", "source")
    return mixing.report(*mixing.mixture(rows, targets, path=path), path)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    limit, overlap = splitting.limits(table(spark, sf, "split_limit"))
    pieces = splitting.split(table(spark, sf, "documents"), "doc_id", "text", limit, overlap, only_long=True)
    return pieces.where("piece = 0").select("doc_id").distinct()


def p9_pieces(spark: SparkSession, sf: str) -> DataFrame:
    limit, overlap = splitting.limits(table(spark, sf, "split_limit"))
    return splitting.split(table(spark, sf, "documents"), "doc_id", "text", limit, overlap)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p2_found, p2_unmatched, p3_found, p3_segments, p4_found, p4_records, p5_found, p5_fused, p6_found, p6_forms, p6_classes, p7_found, p8_mix, p8_report, p8_quotas, p8_tree, p9_found, p9_pieces)
}

_VALUE = "CASE WHEN {c} IS NULL OR lower(trim({c}, ' \u3000\u00a0')) IN ('', 'null', 'none', 'nil', 'nan', 'n/a', 'na', 'n.a.', 'unknown', 'undefined', '无', '暂无') OR NOT regexp_matches({c}, '[\\p{{L}}\\p{{N}}]') THEN 0 ELSE 1 END"

SQL: dict[str, str] = {
    "p5_found": f"""
        WITH p AS (
            SELECT DISTINCT ON (p.id) p.cluster, p.id, d.precision, p.sources, p.updated_at,
                   {_VALUE.format(c="p.zh_hans")} AS z, {_VALUE.format(c="p.kind")} AS k, {_VALUE.format(c="p.headword")} AS h
            FROM pair p LEFT JOIN dictionary d ON d.id = p.dictionary_id WHERE p.cluster IS NOT NULL
        ), r AS (
            SELECT *, count(*) OVER (PARTITION BY cluster) AS n,
                   row_number() OVER (PARTITION BY cluster ORDER BY precision DESC NULLS LAST, sources DESC NULLS LAST, updated_at DESC NULLS LAST, id) AS o
            FROM p
        ), b AS (
            SELECT cluster, arg_min(id, o) FILTER (z = 1) AS zh_hans, arg_min(id, o) FILTER (k = 1) AS kind,
                   arg_min(id, o) FILTER (h = 1) AS headword, arg_min(id, o - (z + k + h) * CAST(1000000000 AS BIGINT)) AS representative
            FROM r WHERE n > 1 GROUP BY cluster
        )
        SELECT CAST(cluster AS BIGINT) AS cluster, field, pair_id
        FROM b UNPIVOT (pair_id FOR field IN (zh_hans, kind, headword, representative))""",
    "p8_quotas": """
        WITH t AS (SELECT DISTINCT ON (text) coalesce(source, '') AS source, length(text) AS n FROM documents WHERE doc_id IS NOT NULL AND text <> '' ORDER BY text, doc_id),
        a AS (SELECT 2 * sum(n) AS asked FROM t), z AS (SELECT source, sum(n) AS size FROM t GROUP BY 1),
        m AS (SELECT m.source, coalesce(size, 0) AS size, coalesce(size, 0) * greatest(max_repeats, 1) AS most, target_share AS w FROM mix_target m LEFT JOIN z USING (source)),
        o AS (SELECT *, (asked - coalesce(sum(most) OVER (ORDER BY most / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY most / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM m, a WHERE w > 0 AND most > 0),
        v AS (SELECT min(level) FILTER (WHERE most > level * w) AS level FROM o)
        SELECT source, CAST(size AS BIGINT) AS available, CAST(round(CASE WHEN w > 0 AND most > 0 THEN least(most, coalesce(v.level * w, most)) ELSE 0 END) AS BIGINT) AS planned FROM m, v""",
    "p4_records": """
        WITH p AS (
            SELECT DISTINCT id, regexp_replace(lower(en), '[\\p{P}\\p{Z}\\x00-\\x1f]', '', 'g') AS a,
                   regexp_replace(lower(zh), '[\\p{P}\\p{Z}\\x00-\\x1f]', '', 'g') AS b FROM pair
        )
        SELECT min(id) AS first_id, count(*) AS copies FROM p GROUP BY least(a, b), greatest(a, b)""",
    "p4_found": """
        WITH p AS (
            SELECT DISTINCT id, regexp_replace(lower(en), '[\\p{P}\\p{Z}\\x00-\\x1f]', '', 'g') AS a,
                   regexp_replace(lower(zh), '[\\p{P}\\p{Z}\\x00-\\x1f]', '', 'g') AS b FROM pair
        ), g AS (SELECT id, min(id) OVER (PARTITION BY least(a, b), greatest(a, b)) AS first_id FROM p)
        SELECT first_id, id AS copy_id FROM g WHERE id <> first_id""",
}
