"""Queries over entries parsed by plug-ins, and over the staged pairs of their translations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.operators import layers, lookup
from lexlake.plans.dictionary_queries import _E, _S, _entries, _senses, redirect_closure
from lexlake.sources import loading
from lexlake.session import table


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return layers.parse_entries(_entries(spark, sf), F.lit("plain"))


def parsed_senses(spark: SparkSession, sf: str) -> DataFrame:
    return layers.tables(_parsed(spark, sf))["s_sense"].select("entry_id", "dict_id", "ord", "kind", "number", "definition")


def parse_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return layers.coverage(_parsed(spark, sf), "definitions")


def lookup_words(spark: SparkSession, sf: str) -> DataFrame:
    """For every hundredth phrase and headword the entries of each dictionary, through redirects where it has none."""
    e = _entries(spark, sf).select(F.col("id").alias("entry_id"), "dict_id", F.lower("headword").alias("norm"))
    q = e.where("entry_id % 100 = 0").select(F.col("norm").alias("query")).union(_senses(spark, sf).where("id % 100 = 0 and phrase <> ''").select(F.lower("phrase"))).distinct()
    return lookup.direct_or_redirected(q, e, redirect_closure(spark, sf))


def pair_tsv(spark: SparkSession, sf: str) -> DataFrame:
    return loading.tsv_rows(table(spark, sf, "pair").dropDuplicates(["id"])).distinct()


def pair_tmx(spark: SparkSession, sf: str) -> DataFrame:
    """The translation unit of every pair."""
    return table(spark, sf, "pair").dropDuplicates(["id"]).select("id", loading.tmx_unit().alias("unit"))


QUERIES = {f.__name__: f for f in (parsed_senses, parse_coverage, lookup_words, pair_tsv, pair_tmx)}

_X = "replace(replace(replace(coalesce({c}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
SQL = {
    "parsed_senses": f"""WITH {_E}, p AS (SELECT id AS entry_id, dict_id, regexp_extract_all(body, '<p>([^<]*)</p>', 1) AS p FROM e), x AS (SELECT entry_id, dict_id, unnest(p) AS definition, generate_subscripts(p, 1) AS i FROM p)
        SELECT entry_id, dict_id, CAST(i - 1 AS INTEGER) AS ord, 'sense' AS kind, CAST(i AS VARCHAR) AS number, trim(regexp_replace(definition, '[\\s\\p{{Z}}]+', ' ', 'g')) AS definition FROM x""",
    "parse_coverage": f"WITH {_E} SELECT dict_id, count(*) AS entries, CAST(0 AS BIGINT) AS stubs, count(*) AS covered, CAST(0 AS BIGINT) AS failed FROM e GROUP BY dict_id",
    "pair_tsv": "SELECT DISTINCT " + ", ".join(f"regexp_replace(coalesce({c}, ''), '[\\t\\r\\n]', ' ', 'g') AS {c}" for c in ("en", "zh", "kind")) + " FROM pair",
    "pair_tmx": f"""SELECT DISTINCT id, '<tu tuid="' || id || '"><prop type="x-kind">' || {_X.format(c="kind")} || '</prop><tuv xml:lang="en"><seg>' || {_X.format(c="en")} || '</seg></tuv><tuv xml:lang="zh-CN"><seg>' || {_X.format(c="zh")} || '</seg></tuv></tu>' AS unit FROM pair""",
    "lookup_words": f"""WITH RECURSIVE {_E}, {_S},
        edges AS (SELECT DISTINCT e.dict_id, lower(s.phrase) AS source, lower(e.headword) AS target FROM s JOIN e ON e.id = s.entry_id
                  WHERE s.phrase <> '' AND s.kind IN ('derivative', 'phrasal_verb', 'phrase') AND lower(s.phrase) <> lower(e.headword)),
        ends AS (SELECT DISTINCT dict_id, lower(headword) AS target FROM e EXCEPT SELECT dict_id, source FROM edges),
        walk AS (SELECT dict_id, source, target, 1 AS hops FROM edges UNION SELECT w.dict_id, w.source, n.target, w.hops + 1 FROM walk w JOIN edges n ON n.dict_id = w.dict_id AND n.source = w.target WHERE w.hops < 5),
        c AS (SELECT w.dict_id, w.source, w.target, min(w.hops) AS hops FROM walk w JOIN ends USING (dict_id, target) GROUP BY 1, 2, 3),
        q AS (SELECT lower(headword) AS query FROM e WHERE id % 100 = 0 UNION SELECT lower(phrase) FROM s WHERE id % 100 = 0 AND phrase <> ''),
        d AS (SELECT q.query, e.dict_id, e.id AS entry_id, 0 AS hops FROM q JOIN e ON lower(e.headword) = q.query)
        SELECT * FROM d UNION ALL
        SELECT q.query, c.dict_id, e.id, min(c.hops) FROM q JOIN c ON c.source = q.query JOIN e ON e.dict_id = c.dict_id AND lower(e.headword) = c.target
        WHERE (q.query, c.dict_id) NOT IN (SELECT query, dict_id FROM d) GROUP BY 1, 2, 3""",
}
