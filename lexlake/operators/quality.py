"""Invariants: each names rows that must not exist; the answer is how many there are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Closed vocabularies of the tables.
AXES = ("register", "attitude", "time", "frequency", "region", "domain", "selection", "language", "use", "form", "kind", "author")
SENSE_KINDS = ("sense", "phrase", "phrasal_verb", "derivative", "collocation", "note")
LANGUAGES = ("en-en", "en-zh", "en-other", "other")
RECORD_KINDS = ("mdx", "mdd", "archive")


def listed(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


#: (table, what is wrong, condition in SQL that both engines read)
ROW_CHECKS = (
    ("label", "unknown axis", f"axis NOT IN {listed(AXES)}"),
    ("label", "share out of range", "share <= 0 OR share > 1"),
    ("label", "empty value", "trim(value) = ''"),
    ("label", "more publishers than dictionaries", "publishers > n"),
    ("s_sense", "unknown kind", f"kind NOT IN {listed(SENSE_KINDS)}"),
    ("s_sense", "negative order", "ord < 0"),
    ("s_sense", "phrase without text", "kind IN ('phrase', 'phrasal_verb') AND trim(phrase) = ''"),
    ("entry", "empty headword", "trim(headword) = ''"),
    ("pair", "empty side", "trim(en) = '' OR trim(zh) = ''"),
    ("pair", "variants or sources below one", "variants < 1 OR sources < 1"),
    ("pair_cluster", "size below one", "size < 1"),
    ("record_snapshot", "unknown kind", f"kind NOT IN {listed(RECORD_KINDS)}"),
    ("record_snapshot", "unknown language", f"lang NOT IN {listed(LANGUAGES)}"),
    ("record_snapshot", "negative size", "size < 0"),
)
#: (table, column, other table, other column, what is wrong): values that must stand in the other table.
LINK_CHECKS = (
    ("s_sense", "entry_id", "entry", "id", "sense of no entry"),
    ("entry", "dict_id", "dictionary", "id", "entry of no dictionary"),
    ("pair", "cluster", "pair_cluster", "id", "pair of no cluster"),
    ("pair_cluster", "representative", "pair", "id", "representative that is no pair"),
)
#: (table, key, what is wrong): keys that must stand once.
KEY_CHECKS = (("entry", "id", "entry delivered twice"), ("pair", "id", "pair delivered twice"), ("dictionary", "id", "dictionary twice"), ("pair_cluster", "id", "cluster twice"))


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, problem, n) for each invariant, 0 where it holds. Row checks of a table share one pass over it."""
    out = []
    for name in dict.fromkeys(t for t, *_ in ROW_CHECKS):
        own = [(p, c) for t, p, c in ROW_CHECKS if t == name]
        counts = tables[name].agg(*(F.count_if(F.expr(c)).alias(f"c{i}") for i, (_, c) in enumerate(own)))
        each = F.array(*(F.struct(F.lit(p).alias("problem"), F.col(f"c{i}").alias("n")) for i, (p, _) in enumerate(own)))
        out.append(counts.select(F.lit(name).alias("tbl"), F.explode(each).alias("x")).select("tbl", "x.problem", "x.n"))
    for name, column, other, key, problem in LINK_CHECKS:
        lost = tables[name].select(F.col(column).alias("v")).where("v is not null").join(tables[other].select(F.col(key).alias("v")).distinct(), "v", "left_anti")
        out.append(lost.agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), F.lit(problem).alias("problem"), "n"))
    for name, key, problem in KEY_CHECKS:
        twice = tables[name].groupBy(key).count().where("count > 1")
        out.append(twice.agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), F.lit(problem).alias("problem"), "n"))
    return reduce(DataFrame.unionByName, out)


def violations_sql() -> str:
    parts = [f"SELECT '{t}' AS tbl, '{p}' AS problem, count(*) FILTER (WHERE {c}) AS n FROM {t}" for t, p, c in ROW_CHECKS]
    parts += [f"SELECT '{t}', '{p}', count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {o})" for t, c, o, k, p in LINK_CHECKS]
    parts += [f"SELECT '{t}', '{p}', count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)" for t, k, p in KEY_CHECKS]
    return " UNION ALL ".join(parts)


def failing(found: DataFrame) -> DataFrame:
    return found.where("n > 0")
