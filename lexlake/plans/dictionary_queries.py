"""Queries over raw entries, structured senses and their derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.functions import glosses, text
from lexlake.operators import graph, keys, lookup
from lexlake.operators.once import once
from lexlake.session import table


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return once(table(spark, sf, "entry"), "id", "loaded_at")


def _senses(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "s_sense").dropDuplicates(["id"])


def entry_keys(spark: SparkSession, sf: str) -> DataFrame:
    return keys.entry_keys(_entries(spark, sf), table(spark, sf, "dictionary"))


def sense_keys(spark: SparkSession, sf: str) -> DataFrame:
    return keys.sense_keys(_senses(spark, sf), entry_keys(spark, sf))


def sense_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return keys.shard_offsets(_senses(spark, sf), "dict_id")


def dictionary_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered digests of the records and the senses of each dictionary."""
    records = keys.ordered_digests(_entries(spark, sf), "dict_id", ["id"], ["headword", "body"]).select("dict_id", F.col("n").alias("n_records"), F.col("digest").alias("records"))
    senses = keys.ordered_digests(_senses(spark, sf), "dict_id", ["entry_id", "ord", "id"], ["ord", "kind", "phrase", "definition", "definition_zh"])
    return records.join(senses.select("dict_id", F.col("n").alias("n_senses"), F.col("digest").alias("senses")), "dict_id", "left")


def headword_set(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct lower-case headwords of all dictionaries and phrases."""
    a = table(spark, sf, "entry").select(F.lower("headword").alias("norm"))
    b = table(spark, sf, "s_sense").where("phrase <> ''").select(F.lower("phrase"))
    return a.union(b).distinct()


def nested_summary(spark: SparkSession, sf: str) -> DataFrame:
    """For each entry with senses how many there are, and its first six as one list."""
    return lookup.first_of_each(_senses(spark, sf), "entry_id", ["ord", "id"], "definition", 6)


def sense_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """For each dictionary the entries, those with a definition, a translation, a collocation, a label."""
    s = _senses(spark, sf).groupBy("entry_id").agg(
        F.bool_or(F.col("definition") != "").alias("d"), F.bool_or(F.coalesce("definition_zh", F.lit("")) != "").alias("z"),
        F.bool_or(F.col("kind") == "collocation").alias("c"), F.bool_or(F.coalesce(F.size("labels"), F.lit(0)) > 0).alias("l"),
    )
    e = _entries(spark, sf).select(F.col("id").alias("entry_id"), "dict_id").join(s, "entry_id", "left")
    return e.groupBy("dict_id").agg(F.count("*").alias("n_entries"), *(F.count_if(F.col(c)).alias(n) for c, n in (("d", "n_defined"), ("z", "n_translated"), ("c", "n_collocations"), ("l", "n_labelled"))))


def headword_profile(spark: SparkSession, sf: str) -> DataFrame:
    """What each dictionary holds: entries, distinct and repeated headwords, several words, sizes."""
    words = _entries(spark, sf).groupBy("dict_id", "headword").agg(F.count("*").alias("n"), F.sum(F.octet_length("body")).alias("size"), F.max(F.octet_length("body")).alias("most"))
    return words.groupBy("dict_id").agg(
        F.sum("n").alias("n_entries"), F.count("*").alias("n_headwords"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("n_repeated"),
        F.sum(F.when(F.col("headword").contains(" "), F.col("n")).otherwise(0)).alias("n_several_words"), F.sum("size").alias("bytes"), F.max("most").alias("max_bytes"),
    )


def sense_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Senses by dictionary and kind, with totals over either and both."""
    return _senses(spark, sf).cube("dict_id", "kind").agg(F.count("*").alias("n"))


def zh_terms(spark: SparkSession, sf: str) -> DataFrame:
    return _senses(spark, sf).select(F.col("id").alias("sense_id"), F.explode(glosses.zh_terms(F.col("definition_zh"))).alias("term"))


def gloss_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    """For each headword of one word its character pairs, those of the earliest senses first, at most 60."""
    e = _entries(spark, sf).where("headword rlike '^[A-Za-z]+$'").select(F.col("id").alias("entry_id"), F.lower("headword").alias("word"))
    grams = _senses(spark, sf).join(e, "entry_id").select("word", "entry_id", "ord", "id", F.posexplode(glosses.gloss_bigrams(F.col("definition_zh"))).alias("at", "gram"))
    first = grams.groupBy("word", "gram").agg(F.min(F.struct("entry_id", "ord", "id", "at")).alias("o"))
    n = F.row_number().over(Window.partitionBy("word").orderBy("o", "gram"))
    return first.withColumn("n", n).where(F.col("n") <= glosses.MAX_BIGRAMS).select("word", "gram", "n")


def zh_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """English headwords for the first characters of every hundredth sense's gloss: exact terms first, then terms that contain them."""
    terms = zh_terms(spark, sf)
    queries = terms.where("sense_id % 100 = 0").groupBy(F.col("sense_id").alias("query_id")).agg(F.substring(F.min("term"), 1, 4).alias("query"))
    senses = _senses(spark, sf)
    e = _entries(spark, sf).select(F.col("id").alias("entry_id"), "headword")
    return lookup.by_gloss(queries, terms, senses.select(F.col("id").alias("sense_id"), "entry_id", "dict_id"), e)


def redirect_closure(spark: SparkSession, sf: str) -> DataFrame:
    """For each phrase of a sense what it leads to, through at most five redirects of its dictionary."""
    s = _senses(spark, sf).where("phrase <> '' and kind in ('derivative', 'phrasal_verb', 'phrase')")
    e = _entries(spark, sf).select(F.col("id").alias("entry_id"), "dict_id", F.lower("headword").alias("target"))
    edges = s.select("entry_id", F.lower("phrase").alias("source")).join(e, "entry_id").select("dict_id", "source", "target").where("source <> target").distinct()
    targets = e.select("dict_id", "target").distinct()
    return graph.redirect_closure(edges, targets.join(edges.select("dict_id", F.col("source").alias("target")), ["dict_id", "target"], "left_anti"))


def family_components(spark: SparkSession, sf: str) -> DataFrame:
    """Connected groups of words that dictionaries list under each other; named by their first word."""
    e = _entries(spark, sf).select(F.col("id").alias("entry_id"), F.lower("headword").alias("base"))
    links = _senses(spark, sf).where("phrase <> ''").join(e, "entry_id").select("base", F.lower("phrase").alias("member"))
    return graph.components(links.where("base <> member").distinct(), "base", "member")


def link_names(spark: SparkSession, sf: str) -> DataFrame:
    """Classes named in the markup of entries, with how often."""
    names = F.regexp_extract_all(F.col("body"), F.lit('class="([^"]*)"'), 1)
    return _entries(spark, sf).select(F.explode(names).alias("class")).groupBy("class").agg(F.count("*").alias("n"))


def plain_bodies(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("id", text.plain(F.col("body"), 60).alias("text"))


def word_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Syllables, consonants and spelling keys of one-word headwords."""
    w = table(spark, sf, "entry").select(F.lower("headword").alias("word")).where("word rlike '^[a-z]+$'").distinct()
    c = F.col("word")
    return w.select("word", text.syllables(c).alias("syllables"), text.skeleton(c).alias("skeleton"), text.consonant_spelling(c).alias("consonants"))


def spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Headwords of one dictionary that spell one word, met by their consonant spelling."""
    w = table(spark, sf, "entry").select("dict_id", F.lower("headword").alias("word")).where("word rlike '^[a-z]+$'").distinct()
    keyed = w.withColumn("key", text.consonant_spelling(F.col("word")))
    a, b = keyed.select("dict_id", "key", F.col("word").alias("word_a")), keyed.select("dict_id", "key", F.col("word").alias("word_b"))
    return a.join(b, ["dict_id", "key"]).where("word_a < word_b").select("dict_id", "word_a", "word_b")


QUERIES = {
    f.__name__: f
    for f in (
        entry_keys, sense_keys, sense_offsets, dictionary_versions, headword_set, nested_summary, sense_coverage, headword_profile, sense_kinds,
        zh_terms, gloss_bigrams, zh_lookup, redirect_closure, family_components, link_names, plain_bodies, word_shapes, spelling_variants,
    )
}

_E = "e AS (SELECT DISTINCT ON (id) * FROM entry ORDER BY id, loaded_at DESC)"
_S = "s AS (SELECT DISTINCT ON (id) * FROM s_sense)"
_K = "k AS (SELECT e.id AS entry_id, concat_ws(':', d.key, row_number() OVER (PARTITION BY e.dict_id, e.headword ORDER BY e.id), e.headword) AS key FROM e JOIN dictionary d ON d.id = e.dict_id)"
_TERMS = """t AS (
    SELECT DISTINCT sense_id, term FROM (
        SELECT id AS sense_id, unnest(list_transform(regexp_split_to_array(regexp_replace(definition_zh, '[（(【\\[〔〈][^）)】\\]〕〉]*[）)】\\]〕〉]', ' ', 'g'), '[；;，,、/|]'),
               lambda p: trim(p, ' .。…～~:："''“”‘’`'))) AS term FROM s WHERE definition_zh IS NOT NULL)
    WHERE regexp_matches(term, '[㐀-䶿一-鿿]') AND length(term) <= 16)"""

SQL = {
    "entry_keys": f"WITH {_E}, {_K} SELECT * FROM k",
    "sense_keys": f"WITH {_E}, {_K}, {_S} SELECT s.id AS sense_id, concat_ws(':', k.key, s.ord) AS key FROM s JOIN k USING (entry_id)",
    "sense_offsets": f"WITH {_S}, n AS (SELECT dict_id, count(*) AS n FROM s GROUP BY 1) SELECT dict_id, n, CAST(coalesce(sum(n) OVER (ORDER BY dict_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS first_id FROM n",
    "headword_set": "SELECT lower(headword) AS norm FROM entry UNION SELECT lower(phrase) FROM s_sense WHERE phrase <> ''",
    "nested_summary": f"""WITH {_S}, r AS (SELECT entry_id, definition, row_number() OVER w AS n, count(*) OVER (PARTITION BY entry_id) AS total FROM s WINDOW w AS (PARTITION BY entry_id ORDER BY ord, id))
        SELECT entry_id, max(total) AS total, string_agg(definition, ' | ' ORDER BY n) AS firsts FROM r WHERE n <= 6 GROUP BY entry_id""",
    "sense_coverage": f"""WITH {_E}, {_S}, x AS (SELECT entry_id, bool_or(definition <> '') AS d, bool_or(coalesce(definition_zh, '') <> '') AS z, bool_or(kind = 'collocation') AS c, bool_or(coalesce(len(labels), 0) > 0) AS l FROM s GROUP BY 1)
        SELECT dict_id, count(*) AS n_entries, count(*) FILTER (WHERE d) AS n_defined, count(*) FILTER (WHERE z) AS n_translated, count(*) FILTER (WHERE c) AS n_collocations, count(*) FILTER (WHERE l) AS n_labelled FROM e LEFT JOIN x ON x.entry_id = e.id GROUP BY dict_id""",
    "headword_profile": f"""WITH {_E}, w AS (SELECT dict_id, headword, count(*) AS n, sum(octet_length(encode(body))) AS size, max(octet_length(encode(body))) AS most FROM e GROUP BY 1, 2)
        SELECT dict_id, CAST(sum(n) AS BIGINT) AS n_entries, count(*) AS n_headwords, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS n_repeated,
               CAST(sum(CASE WHEN contains(headword, ' ') THEN n ELSE 0 END) AS BIGINT) AS n_several_words, CAST(sum(size) AS BIGINT) AS bytes, max(most) AS max_bytes FROM w GROUP BY dict_id""",
    "sense_kinds": f"WITH {_S} SELECT dict_id, kind, count(*) AS n FROM s GROUP BY CUBE (dict_id, kind)",
    "zh_terms": f"WITH {_S}, {_TERMS} SELECT sense_id, term FROM t",
    "gloss_bigrams": f"""WITH {_E}, {_S}, x AS (
            SELECT lower(e.headword) AS word, s.entry_id, s.ord, s.id,
                   regexp_extract_all(regexp_replace(s.definition_zh, '[（(【\\[〔〈][^）)】\\]〕〉]*[）)】\\]〕〉]', ' ', 'g'), '[㐀-䶿一-鿿]+') AS runs
            FROM s JOIN e ON e.id = s.entry_id WHERE regexp_full_match(e.headword, '[A-Za-z]+') AND s.definition_zh IS NOT NULL
        ), g AS (
            SELECT word, entry_id, ord, id, r, run, unnest(generate_series(1, greatest(length(run) - 1, 1))) AS i
            FROM (SELECT word, entry_id, ord, id, unnest(runs) AS run, generate_subscripts(runs, 1) AS r FROM x)
        ), o AS (
            SELECT word, run[i : i + 1] AS gram, min({{'a': entry_id, 'b': ord, 'c': id, 'd': r, 'e': i}}) AS o FROM g GROUP BY 1, 2
        )
        SELECT word, gram, CAST(row_number() OVER (PARTITION BY word ORDER BY o, gram) AS INTEGER) AS n FROM o QUALIFY n <= 60""",
    "zh_lookup": f"""WITH {_E}, {_S}, {_TERMS}, q AS (SELECT sense_id AS query_id, min(term)[1:4] AS query FROM t WHERE sense_id % 100 = 0 GROUP BY 1),
        h AS (SELECT q.query_id, t.sense_id, t.term, t.term = q.query AS exact FROM q JOIN t ON contains(t.term, q.query)),
        b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY NOT exact, length(term), term, sense_id) AS n FROM h QUALIFY n <= 5000),
        g AS (SELECT b.query_id, lower(e.headword) AS word, count(DISTINCT s.dict_id) FILTER (b.exact) AS exact, count(DISTINCT s.dict_id) AS dictionaries
              FROM b JOIN s ON s.id = b.sense_id JOIN e ON e.id = s.entry_id GROUP BY 1, 2)
        SELECT query_id, word, exact, dictionaries, CAST(row_number() OVER (PARTITION BY query_id ORDER BY exact DESC, dictionaries DESC, length(word), word) AS INTEGER) AS rank FROM g QUALIFY rank <= 40""",
    "redirect_closure": f"""WITH RECURSIVE {_E}, {_S},
        edges AS (SELECT DISTINCT e.dict_id, lower(s.phrase) AS source, lower(e.headword) AS target FROM s JOIN e ON e.id = s.entry_id
                  WHERE s.phrase <> '' AND s.kind IN ('derivative', 'phrasal_verb', 'phrase') AND lower(s.phrase) <> lower(e.headword)),
        ends AS (SELECT DISTINCT dict_id, lower(headword) AS target FROM e EXCEPT SELECT dict_id, source FROM edges),
        walk AS (
            SELECT dict_id, source, target, 1 AS hops FROM edges
            UNION
            SELECT w.dict_id, w.source, n.target, w.hops + 1 FROM walk w JOIN edges n ON n.dict_id = w.dict_id AND n.source = w.target WHERE w.hops < 5
        )
        SELECT w.dict_id, w.source, w.target, min(w.hops) AS hops FROM walk w JOIN ends USING (dict_id, target) GROUP BY 1, 2, 3""",
    "family_components": f"""WITH RECURSIVE {_E}, {_S},
        l AS (SELECT DISTINCT lower(e.headword) AS a, lower(s.phrase) AS b FROM s JOIN e ON e.id = s.entry_id WHERE s.phrase <> '' AND lower(e.headword) <> lower(s.phrase)),
        u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r AS (SELECT a AS node, a AS seen FROM u UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.seen)
        SELECT node, min(seen) AS component FROM r GROUP BY node""",
    "link_names": f"""WITH {_E}, x AS (SELECT unnest(regexp_extract_all(body, 'class="([^"]*)"', 1)) AS class FROM e) SELECT class, count(*) AS n FROM x GROUP BY 1""",
    "plain_bodies": f"""WITH {_E}, x AS (SELECT id, trim(regexp_replace(regexp_replace(body, '<[^>]*>', ' ', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g')) AS t FROM e)
        SELECT id, CASE WHEN length(t) > 60 THEN rtrim(t[1:60]) || '…' ELSE t END AS text FROM x""",
    "word_shapes": """WITH w AS (SELECT DISTINCT lower(headword) AS word FROM entry WHERE regexp_full_match(lower(headword), '[a-z]+')),
        x AS (SELECT word, len(regexp_extract_all(word, '[aeiouy]+')) AS g FROM w)
        SELECT word, CAST(greatest(g - CASE WHEN regexp_matches(word, '[^aeiouyl]e$') AND g > 1 THEN 1 ELSE 0 END, 1) AS INTEGER) AS syllables,
               """
    + "{} AS skeleton, {} AS consonants FROM x",
    "spelling_variants": "",
}


def _once(c: str) -> str:
    """Doubled letters as one, for an engine whose patterns know no references back."""
    for letter in "abcdefghijklmnopqrstuvwxyz":
        c = f"replace({c}, '{letter * 2}', '{letter}')"
    return c


_CONSONANTS = _once("regexp_replace(regexp_replace({w}, 'ck|[cq]', 'k', 'g'), 'ph', 'f', 'g')")
_C = _CONSONANTS.format(w="word")
SQL["word_shapes"] = SQL["word_shapes"].format(f"({_C})[1:1] || regexp_replace(({_C})[2:], '[aeiouy]+', '', 'g')", _C)
SQL["spelling_variants"] = f"""WITH w AS (SELECT DISTINCT dict_id, lower(headword) AS word FROM entry WHERE regexp_full_match(lower(headword), '[a-z]+')),
    k AS (SELECT *, {_CONSONANTS.format(w="word")} AS key FROM w)
    SELECT a.dict_id, a.word AS word_a, b.word AS word_b FROM k a JOIN k b ON a.dict_id = b.dict_id AND a.key = b.key AND a.word < b.word"""
