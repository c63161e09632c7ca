"""Queries over evidence-counted inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.functions import html, inflect
from lexlake.operators import analyzer, inventories, quality
from lexlake.plans.dictionary_queries import _E, _S, _entries, _senses
from lexlake.session import table

#: Definitions that begin with a collocation: (collocate, base).
VERB_NOUN = "^to ([a-z]+) an? ([a-z]+)"
ADJECTIVE_NOUN = "^an? ([a-z-]+) ([a-z]+)"
NUMBER_NOUN = "^([0-9]+) ([a-z]+)"
#: Documents say of words on which syllable they are stressed.
STRESSED = r"stress falls on the (first|second) syllable of ([a-z]+), while ([a-z]+) is stressed on the (first|second)"


def _heard(spark: SparkSession, sf: str) -> DataFrame:
    """(dictionary, region, word, upos, primary, segments, syllables): what documents say of the stress of words.

    The first word of a statement counts as a noun, the second as a verb; forum texts as American.
    """
    at = lambda c: F.when(c == "first", 1).otherwise(2)
    four = F.arrays_zip(*(F.regexp_extract_all("text", F.lit(STRESSED), i).alias(n) for i, n in enumerate(("a", "x", "y", "b"), 1)))
    d = table(spark, sf, "documents").select("dict_id", F.when(F.col("source") == "learner_forum", "US").otherwise("GB").alias("region"), F.explode(four).alias("m"))
    said = F.array(F.struct(F.col("m.a").alias("at"), F.col("m.x").alias("word"), F.lit("NOUN").alias("upos")), F.struct(F.col("m.b").alias("at"), F.col("m.y").alias("word"), F.lit("VERB").alias("upos")))
    rows = d.select("dict_id", "region", F.explode(said).alias("s")).select(F.col("dict_id").alias("dictionary"), "region", F.col("s.word").alias("word"), F.col("s.upos").alias("upos"), at(F.col("s.at")).alias("primary"))
    return rows.distinct().withColumns({"segments": F.col("word"), "syllables": F.regexp_count("word", F.lit("[aeiou]+"))})


def _stress_links(spark: SparkSession, sf: str) -> DataFrame:
    """(base, member, relation): words that one statement compares."""
    pair = F.arrays_zip(F.regexp_extract_all("text", F.lit(STRESSED), 2).alias("a"), F.regexp_extract_all("text", F.lit(STRESSED), 3).alias("b"))
    d = table(spark, sf, "documents").select(F.explode(pair).alias("m")).select(F.col("m.a").alias("base"), F.col("m.b").alias("member")).where("base <> member").distinct()
    return d.withColumn("relation", F.when(F.length("member") > F.length("base"), "prefixed").otherwise("suffixed"))


def _skeletons(spark: SparkSession, sf: str) -> DataFrame:
    """(dict_id, word, sounds): one-word headwords with their vowels as one sign and voiced stops as unvoiced ones."""
    w = F.lower("headword")
    return _entries(spark, sf).where(w.rlike("^[a-z]+$")).select("dict_id", w.alias("word"), F.regexp_replace(F.translate(w, "bdgvzjlmh", "ptkfskrnk"), "[aeiou]+", "a").alias("sounds")).distinct()


def _lemmas(spark: SparkSession, sf: str) -> DataFrame:
    e = _entries(spark, sf).where("lower(headword) rlike '^[a-z]+$'").select(F.col("id").alias("entry_id"), F.lower("headword").alias("lemma"))
    return _senses(spark, sf).where("pos in ('noun', 'verb', 'adjective')").join(e, "entry_id").select("lemma", "pos").distinct()


def label_shares(spark: SparkSession, sf: str) -> DataFrame:
    return inventories.label_shares(inventories.words_of(_senses(spark, sf), _entries(spark, sf)))


def label_categories(spark: SparkSession, sf: str) -> DataFrame:
    """How many categories of dictionaries stand behind each label row."""
    d = table(spark, sf, "dictionary").select(F.concat(F.lit("d"), F.col("id")).alias("d"), "category")
    each = table(spark, sf, "label").dropDuplicates(["id"]).select("id", F.explode("dictionaries").alias("d")).join(d, "d")
    return each.groupBy("id").agg(F.count("*").alias("n"), F.count_distinct("category").alias("categories"))


def invariants(spark: SparkSession, sf: str) -> DataFrame:
    names = {t for t, *_ in (*quality.ROW_CHECKS, *quality.LINK_CHECKS, *quality.KEY_CHECKS)} | {o for _, _, o, *_ in quality.LINK_CHECKS}
    return quality.violations({n: table(spark, sf, n) for n in names})


def inflections(spark: SparkSession, sf: str) -> DataFrame:
    return inventories.inflections(_lemmas(spark, sf))


def form_lemmas(spark: SparkSession, sf: str) -> DataFrame:
    """Forms with all their lemmas."""
    return inventories.form_index(inflections(spark, sf))


def first_lemmas(spark: SparkSession, sf: str) -> DataFrame:
    """The lemma of each form that is none itself, best attested first."""
    n = _entries(spark, sf).groupBy(F.lower("headword").alias("lemma")).agg(F.count_distinct("dict_id").alias("n"))
    return inventories.first_lemma(inflections(spark, sf), n)


def stress_contrasts(spark: SparkSession, sf: str) -> DataFrame:
    return inventories.stress_contrasts(_heard(spark, sf).drop("syllables"))


def stress_shifts(spark: SparkSession, sf: str) -> DataFrame:
    return inventories.stress_shifts(_heard(spark, sf), _stress_links(spark, sf))


def sound_alikes(spark: SparkSession, sf: str) -> DataFrame:
    """Headwords of one dictionary or more that sound alike but for vowels and voice; those that begin alike and are of one length count as variants."""
    p = _skeletons(spark, sf).select(F.col("dict_id").alias("dictionary"), F.lit("GB").alias("region"), "word", "sounds")
    same = p.select("word", "sounds", F.length("word").alias("n")).distinct()
    variants = same.select(F.col("word").alias("word_a"), "sounds", "n").join(same.select(F.col("word").alias("word_b"), "sounds", "n"), ["sounds", "n"]).where("word_a < word_b and substr(word_a, 1, 3) = substr(word_b, 1, 3)")
    return inventories.sound_alikes(p, variants.select("word_a", "word_b"), least=1)


def confusions(spark: SparkSession, sf: str) -> DataFrame:
    """Sets of headwords of a dictionary that sound alike but for vowels and voice."""
    sets = _skeletons(spark, sf).groupBy("dict_id", "sounds").agg(F.array_sort(F.collect_set("word")).alias("words")).where("size(words) > 1")
    return inventories.confusions(sets.select("words", F.when(F.size("words") > 2, "which_word").otherwise("confused").alias("kind"), F.col("dict_id").alias("dictionary")))


def collocations(spark: SparkSession, sf: str) -> DataFrame:
    """Collocations in the definitions of all senses: a verb or an adjective with its noun, or a number with it."""
    text = F.lower("definition")
    verb, adjective, number = (F.regexp_extract(text, p, 0) != "" for p in (VERB_NOUN, ADJECTIVE_NOUN, NUMBER_NOUN))

    def part(i: int):
        return F.when(verb, F.regexp_extract(text, VERB_NOUN, i)).when(adjective, F.regexp_extract(text, ADJECTIVE_NOUN, i)).otherwise(F.regexp_extract(text, NUMBER_NOUN, i))

    each = _senses(spark, sf).where(verb | adjective | number).select(
        F.col("dict_id").alias("dictionary"), F.col("id").alias("ord"), part(2).alias("base"), F.when(F.col("pos") == "noun", "NOUN").when(F.col("pos") == "verb", "VERB").otherwise("").alias("base_pos"),
        part(1).alias("key"), part(0).alias("pattern"), F.when(verb, "verb_obj").when(adjective, "adj_noun").otherwise("untyped").alias("relation"),
        (F.col("ord") % 2 == 0).alias("free"), F.coalesce("definition_zh", F.lit("")).alias("gloss"),
    )
    return inventories.collocations(each)


def level_senses(spark: SparkSession, sf: str) -> DataFrame:
    """How many senses of each number the entries of a word have."""
    e = _entries(spark, sf).select(F.col("id").alias("entry_id"), F.lower("headword").alias("word"), "body")
    marks = _senses(spark, sf).where("number is not null").groupBy("entry_id", F.col("dict_id").alias("dictionary"), "kind", F.col("number").alias("value")).agg(F.count("*").alias("n"))
    return inventories.level_senses(marks.join(e, "entry_id").select("dictionary", "word", "body", F.lit("number").alias("scheme"), "value", "kind", "n"))


def word_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Register and region labels of each word side by side."""
    rows = table(spark, sf, "label").dropDuplicates(["id"])
    a = rows.where("axis = 'register'").select("word", "pos", F.col("value").alias("level"))
    return inventories.facts_of_words(a, rows.where("axis = 'region'").select("word", "pos", F.col("value").alias("label")))


def span_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The stretches of every document between the ends of its sentences and of each two sentences that follow each other."""
    parts = table(spark, sf, "documents").where("text is not null").select(F.col("doc_id").alias("text_id"), F.posexplode(F.split("text", r"\. ")).alias("i", "s"))
    w = Window.partitionBy("text_id").orderBy("i")
    each = parts.select("text_id", "i", F.length("s").cast("long").alias("n")).withColumn("end", F.sum(F.col("n") + 2).over(w))
    each = each.select("text_id", "i", (F.col("end") - F.col("n") - 2).alias("begin"), "end").withColumn("both", F.lead("end").over(w))
    one = each.select("text_id", (2 * F.col("i")).alias("span_id"), "begin", "end")
    return analyzer.segments(one.unionByName(each.where("both is not null").select("text_id", (2 * F.col("i") + 1).alias("span_id"), "begin", F.col("both").alias("end"))))


def resolved_spans(spark: SparkSession, sf: str) -> DataFrame:
    """The senses of each entry as matches of the words of their definitions: those that no better one covers."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("definition"), F.lit("([a-z]+)"), 1))
    m = _senses(spark, sf).where("definition is not null").select(
        F.col("id").alias("match_id"), F.col("entry_id").alias("sent_id"), F.when(F.col("kind") == "collocation", "collocation").otherwise("phrase").alias("source"), words.alias("literals"),
        F.col("ord").alias("n_slots"), F.coalesce(F.size("labels"), F.lit(0)).alias("n"), F.lit(1).alias("publishers"), F.col("id").alias("item_id"),
    )
    return analyzer.resolve(m.where("size(literals) > 0")).select("match_id")


def spelling_suggestions(spark: SparkSession, sf: str) -> DataFrame:
    """For every hundredth headword, with a letter too many, the forms it may be."""
    forms = _entries(spark, sf).groupBy(F.lower("headword").alias("form")).agg(F.count_distinct("dict_id").alias("n"))
    w = table(spark, sf, "entry").where("id % 100 = 0").select(F.concat(F.substring(F.lower("headword"), 1, 2), F.lit("q"), F.substr(F.lower("headword"), F.lit(3))).alias("word"))
    return analyzer.spelling_suggestions(w, forms)


def phrase_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Phrases of senses grouped by their keys, the smallest sense first."""
    p = _senses(spark, sf).where("phrase <> ''").select(F.col("id").alias("record_id"), F.col("dict_id").alias("preference"), F.array(inventories.phrase_key(F.split(F.lower("phrase"), " "))).alias("keys"))
    return inventories.phrase_groups(p)


def entry_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The visible lines of every entry."""
    return _entries(spark, sf).select("id", F.posexplode(F.split(html.to_lines("body"), "\n")).alias("at", "line"))


QUERIES = {
    f.__name__: f
    for f in (
        label_shares, label_categories, invariants, inflections, form_lemmas, first_lemmas, stress_contrasts, stress_shifts, sound_alikes, confusions, collocations,
        level_senses, word_facts, span_segments, resolved_spans, spelling_suggestions, phrase_groups, entry_lines,
    )
}

_WORDS = f"""{_E}, {_S}, w AS (SELECT s.id, s.dict_id, s.labels,
        lower(trim(CASE WHEN s.kind IN ('phrase', 'phrasal_verb', 'derivative') AND trim(s.phrase) <> '' THEN s.phrase ELSE e.headword END)) AS word,
        CASE WHEN s.kind IN ('phrase', 'phrasal_verb') AND trim(s.phrase) <> '' THEN 'phrase' ELSE 'word' END AS word_kind
        FROM s JOIN e ON e.id = s.entry_id WHERE s.kind <> 'note')"""
_LEMMAS = f"{_E}, {_S}, l AS (SELECT DISTINCT lower(e.headword) AS lemma, s.pos FROM s JOIN e ON e.id = s.entry_id WHERE regexp_full_match(lower(e.headword), '[a-z]+') AND s.pos IN ('noun', 'verb', 'adjective'))"
_FORMS = f"{_LEMMAS}, f AS (SELECT lemma, pos, f.slot AS slot, f.form AS form, f.region AS region FROM (SELECT lemma, pos, unnest({inflect.sql('lemma', 'pos')}) AS f FROM l))"
_SAID = f"""d AS (SELECT dict_id AS dictionary, CASE WHEN source = 'learner_forum' THEN 'US' ELSE 'GB' END AS region, unnest(list_zip({", ".join(f"regexp_extract_all(text, '{STRESSED}', {i})" for i in range(1, 5))})) AS m FROM documents)"""
_HEARD = f"""{_SAID}, h AS (SELECT DISTINCT dictionary, region, word, upos, CASE WHEN said = 'first' THEN 1 ELSE 2 END AS prim, word AS segments, len(regexp_extract_all(word, '[aeiou]+')) AS syllables
        FROM (SELECT dictionary, region, m[2] AS word, 'NOUN' AS upos, m[1] AS said FROM d UNION ALL SELECT dictionary, region, m[3], 'VERB', m[4] FROM d))"""
_SKELETONS = f"""{_E}, k AS (SELECT DISTINCT dict_id, lower(headword) AS word, regexp_replace(translate(lower(headword), 'bdgvzjlmh', 'ptkfskrnk'), '[aeiou]+', 'a', 'g') AS sounds FROM e WHERE regexp_full_match(lower(headword), '[a-z]+'))"""

SQL = {
    "label_shares": f"""WITH {_WORDS}, x AS (SELECT DISTINCT id, dict_id, word, word_kind, label FROM (SELECT id, dict_id, word, word_kind, lower(trim(regexp_replace(unnest(labels), '[\\s\\p{{Z}}]+', ' ', 'g'))) AS label FROM w) WHERE label <> ''),
        g AS (SELECT word, word_kind, label, dict_id, count(*) AS senses FROM x GROUP BY ALL), t AS (SELECT word, word_kind, dict_id, count(*) AS total FROM w GROUP BY ALL)
        SELECT word, word_kind, label, count(*) AS n, CAST(sum(senses) AS BIGINT) AS senses, sum(senses) / sum(total) AS share FROM g JOIN t USING (word, word_kind, dict_id) GROUP BY 1, 2, 3""",
    "label_categories": "SELECT id, count(*) AS n, count(DISTINCT category) AS categories FROM (SELECT id, unnest(dictionaries) AS d FROM (SELECT DISTINCT ON (id) * FROM label)) l JOIN dictionary y ON 'd' || y.id = l.d GROUP BY l.id".replace("SELECT id, count", "SELECT l.id, count", 1),
    "invariants": quality.violations_sql(),
    "inflections": f"WITH {_FORMS} SELECT * FROM f",
    "form_lemmas": f"WITH {_FORMS} SELECT form, string_agg(DISTINCT lemma, ' ' ORDER BY lemma) AS lemmas FROM f GROUP BY form",
    "first_lemmas": f"""WITH {_FORMS}, n AS (SELECT lower(headword) AS lemma, count(DISTINCT dict_id) AS n FROM e GROUP BY 1)
        SELECT form, arg_min(lemma, {{'a': -n, 'b': lemma}}) AS lemma FROM (SELECT DISTINCT form, lemma FROM f) JOIN n USING (lemma) WHERE form NOT IN (SELECT lemma FROM n) GROUP BY form""",
    "stress_contrasts": f"""WITH {_HEARD}, us AS (SELECT DISTINCT dictionary, word FROM h WHERE region = 'US'), have AS (SELECT DISTINCT dictionary, word, upos FROM h WHERE region = 'US'),
        i AS (SELECT *, true AS own FROM h UNION ALL SELECT g.* REPLACE ('US' AS region), false FROM h g WHERE region = 'GB' AND EXISTS (SELECT 1 FROM us WHERE us.dictionary = g.dictionary AND us.word = g.word)
              AND NOT EXISTS (SELECT 1 FROM have v WHERE v.dictionary = g.dictionary AND v.word = g.word AND v.upos = g.upos)),
        b AS (SELECT dictionary, region, word, upos, list_sort(list(DISTINCT prim)) AS p, list(DISTINCT segments) AS s, bool_or(own) AS own FROM i GROUP BY 1, 2, 3, 4),
        c AS (SELECT x.dictionary, x.word, x.upos AS pos_a, y.upos AS pos_b, x.own AND y.own AS full_own,
                     CASE WHEN NOT list_has_any(x.p, y.p) THEN 'stress' WHEN NOT list_has_any(x.s, y.s) THEN 'sounds' WHEN x.p <> y.p THEN 'stress (optional)' ELSE '' END AS change
              FROM b x JOIN b y ON y.dictionary = x.dictionary AND y.region = x.region AND y.word = x.word AND x.upos < y.upos WHERE x.own OR y.own),
        k AS (SELECT dictionary, word, pos_a, pos_b, CASE WHEN full_own OR change LIKE 'stress%' THEN change ELSE '' END AS change FROM c),
        v AS (SELECT DISTINCT dictionary, word, pos_a, pos_b, change FROM k WHERE change <> ''), e AS (SELECT word, pos_a, pos_b, change, count(*) AS v FROM v GROUP BY ALL),
        t AS (SELECT word, pos_a, pos_b, arg_max(change, {{'v': v, 'c': change}}) AS top, bool_or(change = 'stress') AND bool_or(change = 'stress (optional)') AS mixed FROM e GROUP BY 1, 2, 3),
        n AS (SELECT word, pos_a, pos_b, count(*) FILTER (WHERE told) AS n, count(*) FILTER (WHERE NOT told) AS n_without FROM (SELECT dictionary, word, pos_a, pos_b, bool_or(change <> '') AS told FROM k GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3)
        SELECT word, pos_a, pos_b, CASE WHEN mixed THEN 'stress (optional)' ELSE top END AS change, n, n_without FROM t JOIN n USING (word, pos_a, pos_b)""",
    "stress_shifts": f"""WITH {_HEARD}, l AS (SELECT DISTINCT m[2] AS base, m[3] AS member, CASE WHEN length(m[3]) > length(m[2]) THEN 'prefixed' ELSE 'suffixed' END AS relation FROM d WHERE m[2] <> m[3]),
        g AS (SELECT dictionary, region, word, list(DISTINCT prim) AS s, list(DISTINCT syllables - prim) AS e FROM h GROUP BY 1, 2, 3),
        r AS (SELECT l.*, b.dictionary, CASE WHEN relation = 'prefixed' THEN list_has_any(b.e, m.e) ELSE list_has_any(b.s, m.s) END AS kept
              FROM l JOIN g b ON b.word = l.base JOIN g m ON m.word = l.member AND m.dictionary = b.dictionary AND m.region = b.region),
        y AS (SELECT base, member, relation, dictionary, bool_or(NOT kept) AS m, bool_or(kept) AS k FROM r GROUP BY ALL)
        SELECT base, member, relation, count(*) FILTER (WHERE m) AS n_moved, count(*) FILTER (WHERE k) AS n_kept, count(*) FILTER (WHERE m) > count(*) FILTER (WHERE k) AS shift FROM y GROUP BY 1, 2, 3""",
    "sound_alikes": f"""WITH {_SKELETONS} SELECT a.word AS word_a, b.word AS word_b, count(DISTINCT a.dict_id) AS n FROM k a JOIN k b ON b.dict_id = a.dict_id AND b.sounds = a.sounds AND a.word < b.word
        WHERE NOT (length(a.word) = length(b.word) AND a.word[1:3] = b.word[1:3]) GROUP BY 1, 2""",
    "confusions": f"""WITH {_SKELETONS}, n AS (SELECT *, count(*) OVER (PARTITION BY dict_id, sounds) AS n FROM k)
        SELECT a.word AS word_a, b.word AS word_b, string_agg(DISTINCT CASE WHEN a.n > 2 THEN 'which_word' ELSE 'confused' END, ',' ORDER BY CASE WHEN a.n > 2 THEN 'which_word' ELSE 'confused' END) AS kinds, count(DISTINCT a.dict_id) AS n
        FROM n a JOIN n b ON b.dict_id = a.dict_id AND b.sounds = a.sounds AND a.word < b.word GROUP BY 1, 2""",
    "collocations": f"""WITH {_S}, y AS (SELECT *, lower(definition) AS text, CASE WHEN regexp_matches(lower(definition), '{VERB_NOUN}') THEN 1 WHEN regexp_matches(lower(definition), '{ADJECTIVE_NOUN}') THEN 2 WHEN regexp_matches(lower(definition), '{NUMBER_NOUN}') THEN 3 END AS t FROM s),
        z AS (SELECT *, CASE t WHEN 1 THEN regexp_extract(text, '{VERB_NOUN}', ['a', 'b']) WHEN 2 THEN regexp_extract(text, '{ADJECTIVE_NOUN}', ['a', 'b']) ELSE regexp_extract(text, '{NUMBER_NOUN}', ['a', 'b']) END AS m,
              CASE t WHEN 1 THEN regexp_extract(text, '{VERB_NOUN}') WHEN 2 THEN regexp_extract(text, '{ADJECTIVE_NOUN}') ELSE regexp_extract(text, '{NUMBER_NOUN}') END AS pattern FROM y WHERE t IS NOT NULL),
        r AS (SELECT dict_id AS dictionary, id AS ord, m.b AS base, CASE pos WHEN 'noun' THEN 'NOUN' WHEN 'verb' THEN 'VERB' ELSE '' END AS base_pos, m.a AS key, pattern,
              CASE t WHEN 1 THEN 'verb_obj' WHEN 2 THEN 'adj_noun' ELSE 'untyped' END AS relation, ord % 2 = 0 AS free, coalesce(definition_zh, '') AS gloss FROM z),
        b AS (SELECT base, key, arg_max(base_pos, {{'a': n, 'b': base_pos}}) AS t FROM (SELECT base, key, base_pos, count(*) AS n FROM r WHERE base_pos <> '' GROUP BY ALL) GROUP BY 1, 2),
        x AS (SELECT r.* REPLACE (CASE WHEN r.base_pos = '' THEN coalesce(b.t, '') ELSE r.base_pos END AS base_pos) FROM r LEFT JOIN b USING (base, key)),
        v AS (SELECT base, base_pos, key, relation, count(*) AS v FROM x WHERE relation <> 'untyped' GROUP BY ALL), t AS (SELECT base, base_pos, key, arg_max(relation, {{'a': v, 'b': relation}}) AS relation FROM v GROUP BY 1, 2, 3)
        SELECT g.*, coalesce(t.relation, 'untyped') AS relation FROM (SELECT base, base_pos, key, count(*) AS n, count(DISTINCT dictionary) AS n_dictionaries, arg_min(pattern, ord) AS pattern, bool_and(free) AS free,
            coalesce(arg_min(gloss, ord) FILTER (WHERE gloss <> ''), '') AS gloss FROM x GROUP BY 1, 2, 3) g LEFT JOIN t USING (base, base_pos, key)""",
    "level_senses": f"""WITH {_E}, {_S}, c AS (SELECT entry_id, dict_id, kind, number, count(*) AS n FROM s WHERE number IS NOT NULL GROUP BY ALL),
        m AS (SELECT c.dict_id AS dictionary, lower(e.headword) AS word, kind, body, 'number' AS scheme, number AS value, max(n) AS n FROM c JOIN e ON e.id = c.entry_id GROUP BY ALL)
        SELECT dictionary, word, scheme, value, CAST(CASE WHEN bool_or(kind = 'phrasal_verb') THEN max(n) ELSE sum(n) END AS BIGINT) AS senses FROM m GROUP BY 1, 2, 3, 4""",
    "word_facts": """WITH l AS (SELECT DISTINCT ON (id) * FROM label), a AS (SELECT word, pos, string_agg(DISTINCT value, ',' ORDER BY value) AS levels FROM l WHERE axis = 'register' GROUP BY 1, 2),
        b AS (SELECT word, pos, string_agg(DISTINCT value, ',' ORDER BY value) AS labels FROM l WHERE axis = 'region' GROUP BY 1, 2)
        SELECT word, pos, coalesce(levels, '') AS levels, coalesce(labels, '') AS labels FROM a FULL JOIN b USING (word, pos)""",
    "span_segments": """WITH x AS (SELECT doc_id AS text_id, string_split(text, '. ') AS w FROM documents WHERE text IS NOT NULL), y AS (SELECT text_id, i - 1 AS i, length(w[i]) AS n FROM (SELECT text_id, w, unnest(generate_series(1, len(w))) AS i FROM x)),
        z AS (SELECT text_id, i, CAST(sum(n + 2) OVER o AS BIGINT) AS e, n FROM y WINDOW o AS (PARTITION BY text_id ORDER BY i)), s AS (SELECT text_id, 2 * i AS span_id, e - n - 2 AS b, e FROM z
              UNION ALL SELECT text_id, 2 * i + 1, e - n - 2, f FROM (SELECT *, lead(e) OVER (PARTITION BY text_id ORDER BY i) AS f FROM z) WHERE f IS NOT NULL), p AS (SELECT text_id, b AS p FROM s UNION SELECT text_id, e FROM s), c AS (SELECT text_id, p, lead(p) OVER (PARTITION BY text_id ORDER BY p) AS q FROM p)
        SELECT c.text_id, p AS begin, q AS "end", string_agg(CAST(span_id AS VARCHAR), ',' ORDER BY span_id) AS spans FROM c JOIN s ON s.text_id = c.text_id AND s.b <= p AND s.e >= q WHERE q IS NOT NULL GROUP BY 1, 2, 3""",
    "resolved_spans": f"""WITH {_S}, m AS (SELECT id, entry_id, kind, list_distinct(regexp_extract_all(lower(definition), '[a-z]+')) AS w, ord, coalesce(len(labels), 0) AS n FROM s WHERE definition IS NOT NULL),
        o AS (SELECT *, {{'a': -len(w), 'b': ord, 'c': -n, 'd': id}} AS o FROM m WHERE len(w) > 0)
        SELECT id AS match_id FROM o x WHERE kind = 'collocation' OR NOT EXISTS (SELECT 1 FROM o y WHERE y.entry_id = x.entry_id AND y.kind <> 'collocation' AND y.o < x.o AND list_has_all(y.w, x.w))""",
    "phrase_groups": f"""WITH {_S}, p AS (SELECT id AS record_id, dict_id, lower(phrase) AS k FROM s WHERE phrase <> '')
        SELECT record_id, arg_min(record_id, {{'a': dict_id, 'b': record_id}}) OVER (PARTITION BY k) AS founder FROM p""",
    "spelling_suggestions": f"""WITH {_E}, f AS (SELECT lower(headword) AS form, count(DISTINCT dict_id) AS n FROM e GROUP BY 1), w AS (SELECT DISTINCT lower(headword)[1:2] || 'q' || lower(headword)[3:] AS word FROM entry WHERE id % 100 = 0)
        SELECT word, form, CAST(row_number() OVER (PARTITION BY word ORDER BY n DESC, form) AS INTEGER) AS rank FROM w JOIN f ON damerau_levenshtein(word, form) = 1 WHERE word NOT IN (SELECT form FROM f) QUALIFY rank <= 3""",
}
