"""Evidence-counted inventories: labels, inflections, pronunciations, collocations, phrases, levels."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.functions import inflect
from lexlake.functions.text import collapsed
from lexlake.operators.graph import components

# Slots that mean the same in a phrase's key, and words left out of a collocation's.
SAME_SLOT = {"{sb}": "{obj}", "{sth}": "{obj}", "{sb/sth}": "{obj}", "{sb's}": "{poss}", "{one's}": "{poss}", "{sth's}": "{poss}"}
UNKEYED = ("a", "an", "the", "{poss}")


def words_of(senses: DataFrame, entries: DataFrame) -> DataFrame:
    """(sense_id, dict_id, word, word_kind, labels): what each sense is about: its phrase, or its entry's headword."""
    e = entries.select(F.col("id").alias("entry_id"), "headword")
    phrase = F.col("kind").isin("phrase", "phrasal_verb") & (F.trim("phrase") != "")
    own = F.when(phrase | ((F.col("kind") == "derivative") & (F.trim("phrase") != "")), F.col("phrase")).otherwise(F.col("headword"))
    rows = senses.where("kind <> 'note'").join(e, "entry_id")
    return rows.select(F.col("id").alias("sense_id"), "dict_id", F.lower(F.trim(own)).alias("word"), F.when(phrase, F.lit("phrase")).otherwise(F.lit("word")).alias("word_kind"), "labels")


def label_shares(words: DataFrame) -> DataFrame:
    """(word, word_kind, label, n, senses, share): labels of each word with how many dictionaries and senses
    give them, and the share of these among all senses of those dictionaries. A label counts once for a sense."""
    each = words.select("sense_id", "dict_id", "word", "word_kind", F.explode(F.array_distinct(F.transform("labels", lambda x: F.lower(collapsed(x))))).alias("label")).where("label <> ''")
    given = each.groupBy("word", "word_kind", "label", "dict_id").agg(F.count("*").alias("senses"))
    total = words.groupBy("word", "word_kind", "dict_id").agg(F.count("*").alias("total"))
    g = given.join(total, ["word", "word_kind", "dict_id"]).groupBy("word", "word_kind", "label")
    return g.agg(F.count("*").alias("n"), F.sum("senses").alias("senses"), (F.sum("senses") / F.sum("total")).alias("share"))


def inflections(lemmas: DataFrame) -> DataFrame:
    """(lemma, pos, slot, form, region) of rows (lemma, pos): what the rules make of each."""
    return lemmas.select("lemma", "pos", F.explode(inflect.forms(F.col("lemma"), F.col("pos"))).alias("f")).select("lemma", "pos", "f.slot", "f.form", "f.region")


def form_index(forms: DataFrame) -> DataFrame:
    """(form, lemmas): each form with all lemmas that have it, in order."""
    return forms.groupBy("form").agg(F.array_join(F.array_sort(F.collect_set("lemma")), " ").alias("lemmas"))


def first_lemma(forms: DataFrame, attested: DataFrame) -> DataFrame:
    """(form, lemma): for a form that is no lemma itself the best attested lemma, ties by name; attested is (lemma, n)."""
    known = forms.select("form", "lemma").distinct().join(attested, "lemma")
    known = known.join(attested.select(F.col("lemma").alias("form")), "form", "left_anti")
    best = F.min(F.struct((-F.col("n")).alias("n"), "lemma"))["lemma"]
    return known.groupBy("form").agg(best.alias("lemma"))


def inherited(heard: DataFrame) -> DataFrame:
    """heard (dictionary, region, word, upos, primary, segments) with the British forms of parts of speech that a
    dictionary gives no American form of, marked own = false."""
    us = heard.where("region = 'US'").select("dictionary", "word").distinct()
    gb = heard.where("region = 'GB'").join(us, ["dictionary", "word"], "left_semi")
    missing = gb.join(heard.where("region = 'US'").select("dictionary", "word", "upos").distinct(), ["dictionary", "word", "upos"], "left_anti")
    return heard.withColumn("own", F.lit(True)).unionByName(missing.withColumn("region", F.lit("US")).withColumn("own", F.lit(False)))


def stress_contrasts(heard: DataFrame) -> DataFrame:
    """(word, pos_a, pos_b, change, n, n_without): parts of speech of one word that differ in stress or sounds.

    Within a dictionary and region two parts of speech differ in stress if they share no stressed
    syllable, in sounds if they share no string of sounds, and optionally in stress if one has a
    stress that the other lacks. Each dictionary votes once for a change.
    """
    g = inherited(heard).where("upos <> '' and upos <> 'X'").groupBy("dictionary", "region", "word", "upos")
    by = g.agg(F.collect_set("primary").alias("p"), F.collect_set("segments").alias("s"), F.bool_or("own").alias("own"))
    a = by.select("dictionary", "region", "word", *(F.col(c).alias(f"{c}_a") for c in ("upos", "p", "s", "own")))
    b = by.select("dictionary", "region", "word", *(F.col(c).alias(f"{c}_b") for c in ("upos", "p", "s", "own")))
    pairs = a.join(b, ["dictionary", "region", "word"]).where("upos_a < upos_b and (own_a or own_b)")
    change = F.when(~F.arrays_overlap("p_a", "p_b"), "stress").when(~F.arrays_overlap("s_a", "s_b"), "sounds").when(F.array_sort("p_a") != F.array_sort("p_b"), "stress (optional)").otherwise("")
    kept = pairs.withColumn("change", F.when(F.col("own_a") & F.col("own_b") | change.startswith("stress"), change).otherwise(F.lit("")))
    votes = kept.groupBy("word", F.col("upos_a").alias("pos_a"), F.col("upos_b").alias("pos_b"), "dictionary").agg(F.collect_set(F.when(F.col("change") != "", F.col("change"))).alias("changes"))
    n = votes.groupBy("word", "pos_a", "pos_b").agg(F.count_if(F.size("changes") > 0).alias("n"), F.count_if(F.size("changes") == 0).alias("n_without"))
    each = votes.select("word", "pos_a", "pos_b", "dictionary", F.explode("changes").alias("change")).groupBy("word", "pos_a", "pos_b", "change").agg(F.count("*").alias("v"))
    top = each.groupBy("word", "pos_a", "pos_b").agg(F.max(F.struct("v", "change"))["change"].alias("top"), F.collect_set("change").alias("all"))
    both = F.array_contains("all", "stress") & F.array_contains("all", "stress (optional)")
    return top.select("word", "pos_a", "pos_b", F.when(both, F.lit("stress (optional)")).otherwise(F.col("top")).alias("change")).join(n, ["word", "pos_a", "pos_b"])


def stress_shifts(heard: DataFrame, links: DataFrame) -> DataFrame:
    """(base, member, relation, n_moved, n_kept, shift): whether the stress moves from a word to one formed of it.

    Syllables count from the start, for prefixed words from the end; a dictionary moves if the two
    words share no place. heard is (dictionary, region, word, primary, syllables).
    """
    g = heard.groupBy("dictionary", "region", "word").agg(F.collect_set("primary").alias("from_start"), F.collect_set(F.col("syllables") - F.col("primary")).alias("from_end"))
    b = g.select("dictionary", "region", F.col("word").alias("base"), F.col("from_start").alias("bs"), F.col("from_end").alias("be"))
    m = g.select("dictionary", "region", F.col("word").alias("member"), F.col("from_start").alias("ms"), F.col("from_end").alias("me"))
    rows = links.join(b, "base").join(m, ["dictionary", "region", "member"])
    kept = F.when(F.col("relation") == "prefixed", F.arrays_overlap("be", "me")).otherwise(F.arrays_overlap("bs", "ms"))
    by = rows.withColumn("kept", kept).groupBy("base", "member", "relation", "dictionary").agg(F.bool_or(~F.col("kept")).alias("m"), F.bool_or("kept").alias("k"))
    out = by.groupBy("base", "member", "relation").agg(F.count_if("m").alias("n_moved"), F.count_if("k").alias("n_kept"))
    return out.withColumn("shift", F.col("n_moved") > F.col("n_kept"))


def sound_alikes(prons: DataFrame, variants: DataFrame, least: int = 2) -> DataFrame:
    """(word_a, word_b, n): words that at least so many dictionaries pronounce alike, unless one is a variant of the other.

    prons is (dictionary, region, word, sounds), variants (word_a, word_b) in order.
    """
    p = prons.select("dictionary", "region", "sounds", "word").distinct()
    a, b = p.withColumnRenamed("word", "word_a"), p.withColumnRenamed("word", "word_b")
    met = a.join(b, ["dictionary", "region", "sounds"]).where("word_a < word_b")
    return met.groupBy("word_a", "word_b").agg(F.count_distinct("dictionary").alias("n")).where(F.col("n") >= least).join(variants, ["word_a", "word_b"], "left_anti")


def confusions(sets: DataFrame) -> DataFrame:
    """(word_a, word_b, kinds, n) of rows (words, kind, dictionary): each two words of a set, with all evidence."""
    each = sets.select("words", "kind", "dictionary", F.explode("words").alias("word_a"))
    pairs = each.select("word_a", "kind", "dictionary", F.explode("words").alias("word_b")).where("word_a < word_b")
    return pairs.groupBy("word_a", "word_b").agg(F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"), F.count_distinct("dictionary").alias("n"))


def collocations(raw: DataFrame) -> DataFrame:
    """Raw records (dictionary, ord, base, base_pos, key, pattern, relation, free, gloss) as one row for each collocation.

    Records without the base's part of speech join the best attested collocation with the same
    base and key. The relation is the commonest that is typed, ties by the later name; the pattern
    is the first of the dictionary that prints it first; order is free if all records leave it so.
    """
    typed = raw.where("base_pos <> ''").groupBy("base", "key", "base_pos").agg(F.count("*").alias("n"))
    best = typed.groupBy("base", "key").agg(F.max(F.struct("n", "base_pos"))["base_pos"].alias("to"))
    rows = raw.join(best, ["base", "key"], "left").withColumn("base_pos", F.when(F.col("base_pos") == "", F.coalesce("to", F.lit(""))).otherwise(F.col("base_pos")))
    votes = rows.where("relation <> 'untyped'").groupBy("base", "base_pos", "key", "relation").agg(F.count("*").alias("v"))
    top = votes.groupBy("base", "base_pos", "key").agg(F.max(F.struct("v", "relation"))["relation"].alias("relation"))
    g = rows.groupBy("base", "base_pos", "key").agg(
        F.count("*").alias("n"), F.count_distinct("dictionary").alias("n_dictionaries"), F.min_by("pattern", "ord").alias("pattern"), F.bool_and("free").alias("free"),
        F.min_by("gloss", F.when(F.col("gloss") != "", F.col("ord"))).alias("gloss"),
    )
    return g.join(top, ["base", "base_pos", "key"], "left").withColumns({"relation": F.coalesce("relation", F.lit("untyped")), "gloss": F.coalesce("gloss", F.lit(""))})


def phrase_key(tokens: Column, slots: dict[str, str] | None = None) -> Column:
    """The merge key of a phrase's words: object and possessive slots as one."""
    own = slots or SAME_SLOT
    pairs = F.create_map(*(F.lit(x) for kv in own.items() for x in kv))
    return F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(pairs, t), t)), " ")


def collocation_key(tokens: Column) -> Column:
    return F.array_join(F.filter(F.split(phrase_key(tokens), " "), lambda t: ~t.isin(*UNKEYED)), " ")


def anchored(records: Iterable[tuple[int, list[str]]]) -> list[tuple[int, int]]:
    """(record, founder) for records in order of preference, each with the keys of its variants.

    A record joins the group that owns its first key, else one whose founder's first key is among
    its keys, else it founds a group and owns all its keys that are free.
    """
    owner: dict[str, int] = {}
    anchors: dict[str, int] = {}
    out = []
    for record, keys in records:
        group = owner.get(keys[0], next((anchors[k] for k in keys if k in anchors), None))
        if group is None:
            group = record
            anchors[keys[0]] = group
            for k in keys:
                owner.setdefault(k, group)
        out.append((record, group))
    return out


def phrase_groups(records: DataFrame) -> DataFrame:
    """(record_id, founder) of rows (record_id, preference, keys): groups by anchored first registration.

    Records interact only through shared keys. A key that only records of one key have is a group of
    its own, however many they are: its founder is a minimum with partial results. The others are
    taken by connected components of records and keys, each in order of preference and id; such a
    component is as large as one family of phrases with variants.
    """
    own = records.where(F.size("keys") > 0)
    varied = own.where(F.size("keys") > 1).select(F.explode("keys").alias("key")).distinct()
    single = own.where(F.size("keys") == 1).withColumn("key", F.get("keys", F.lit(0)))
    alone = single.join(varied, "key", "left_anti")
    founders = alone.groupBy("key").agg(F.min(F.struct("preference", "record_id"))["record_id"].alias("founder"))
    done = alone.join(founders, "key").select("record_id", "founder")
    rest = own.where(F.size("keys") > 1).unionByName(single.join(varied, "key", "left_semi").select(*own.columns))
    if rest.isEmpty():
        return done
    edges = rest.select(F.concat(F.lit("r"), F.col("record_id")).alias("a"), F.explode(F.transform("keys", lambda k: F.concat(F.lit("k"), k))).alias("b"))
    part = components(edges, "a", "b").where("node like 'r%'").select(F.substring("node", 2, 100).cast("long").alias("record_id"), "component")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["preference", "record_id"])
        return pd.DataFrame(anchored((int(r), list(k)) for r, k in zip(pdf.record_id, pdf["keys"])), columns=["record_id", "founder"])

    return done.unionByName(rest.join(part, "record_id").groupBy("component").applyInPandas(run, "record_id long, founder long"))


def level_senses(marks: DataFrame) -> DataFrame:
    """(dictionary, word, scheme, value, senses) of rows (dictionary, word, body, scheme, value, kind): equal bodies
    of a word count once; a phrasal verb takes the most senses of a body, other words their sum."""
    once = marks.withColumn("h", F.sha2("body", 256)).groupBy("dictionary", "word", "kind", "h", "scheme", "value").agg(F.max("n").alias("n"))
    return once.groupBy("dictionary", "word", "scheme", "value").agg(F.when(F.bool_or(F.col("kind") == "phrasal_verb"), F.max("n")).otherwise(F.sum("n")).alias("senses"))


def facts_of_words(levels: DataFrame, labels: DataFrame) -> DataFrame:
    """(word, pos, levels, labels): a full outer join of two sets of facts, each as a sorted text."""
    a = levels.groupBy("word", "pos").agg(F.array_join(F.array_sort(F.collect_set("level")), ",").alias("levels"))
    b = labels.groupBy("word", "pos").agg(F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"))
    return a.join(b, ["word", "pos"], "full_outer").na.fill("", ["levels", "labels"])


def order_votes(places: DataFrame) -> DataFrame:
    """(item, side, gap) of rows (item, gap, side): the side that most examples show and the gap, if it has two votes
    and either more than half of them or twice those of the next."""
    v = places.groupBy("item", "side", "gap").agg(F.count("*").alias("v"))
    w = Window.partitionBy("item", "side").orderBy(F.desc("v"), "gap")
    ranked = v.withColumns({"r": F.row_number().over(w), "next": F.coalesce(F.lead("v").over(w), F.lit(0)), "all": F.sum("v").over(Window.partitionBy("item", "side"))})
    sides = places.groupBy("item").agg(F.count_if(F.col("side") == "left").alias("l"), F.count_if(F.col("side") == "right").alias("r_")).select("item", F.when(F.col("l") > F.col("r_"), "left").otherwise("right").alias("side"))
    fits = (F.col("v") >= 2) & ((2 * F.col("v") > F.col("all")) | (F.col("v") >= 2 * F.col("next")))
    return sides.join(ranked.where("r = 1"), ["item", "side"], "left").select("item", "side", F.when(fits, F.col("gap")).alias("gap"))
