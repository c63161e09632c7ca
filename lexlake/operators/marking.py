"""Words and spans of analysed text, as nested rows of each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.operators.analyzer import MAX_CHARS, chosen_lemmas


def sized(documents: DataFrame, text: str = "text", most: int = MAX_CHARS) -> DataFrame:
    """documents, failing on a text that is longer than one analysis takes."""
    return documents.where(F.when(F.length(text) > most, F.raise_error(F.concat(F.lit("a text of "), F.length(text).cast("string"), F.lit(" characters is too long")))).otherwise(F.lit(True)).cast("boolean"))


def notable(kinds: Column, n: Column) -> Column:
    """A confusion worth pointing out: a box of its own, or a warning that two dictionaries give."""
    return F.array_contains(kinds, "which_word") | (F.array_contains(kinds, "confused") & (n >= 2))


def words(tokens: DataFrame, forms: DataFrame, facts: DataFrame, misspelt: DataFrame, confusable: DataFrame) -> DataFrame:
    """(sent_id, i, lower, lemma, cefr, labels, wrong_for, unknown, confused_with) of tokens (sent_id, i, lower, pos).

    forms is (form, lemma, upos, n), facts (word, pos, cefr, labels), misspelt (wrong, word),
    confusable (word_a, word_b). A word is unknown if it has three letters or more, no form and isn't
    a known misspelling; names are never unknown.
    """
    lemmas = chosen_lemmas(tokens.select("sent_id", "i", "lower", "pos"), forms).select("sent_id", "i", "lemma")
    known = forms.select(F.col("form").alias("lower"), F.lit(True).alias("known")).distinct()
    wrong = misspelt.groupBy(F.col("wrong").alias("lower")).agg(F.array_sort(F.collect_set("word")).alias("wrong_for"))
    both = confusable.select(F.col("word_a").alias("lemma"), F.col("word_b").alias("o")).union(confusable.select("word_b", "word_a")).groupBy("lemma").agg(F.array_sort(F.collect_set("o")).alias("confused_with"))
    rows = tokens.join(lemmas, ["sent_id", "i"]).join(facts.withColumnRenamed("word", "lemma"), ["lemma", "pos"], "left").join(known, "lower", "left").join(wrong, "lower", "left").join(both, "lemma", "left")
    unknown = F.col("known").isNull() & F.col("wrong_for").isNull() & F.col("lower").rlike("^[a-z]{3,}$") & ~F.col("pos").isin("PROPN", "X")
    return rows.select("sent_id", "i", "lower", "lemma", F.coalesce("cefr", F.lit("")).alias("cefr"), "labels", "wrong_for", unknown.alias("unknown"), "confused_with")


def spans(matches: DataFrame, tokens: DataFrame) -> DataFrame:
    """(match_id, begin, end, ranges) of matches (match_id, sent_id, literals): character ranges of the words, neighbours
    as one; tokens is (sent_id, i, start, end)."""
    each = matches.select("match_id", "sent_id", F.explode("literals").alias("i")).join(tokens.select("sent_id", "i", "start", "end"), ["sent_id", "i"])
    island = F.col("i") - F.row_number().over(Window.partitionBy("match_id").orderBy("i"))
    runs = each.withColumn("run", island).groupBy("match_id", "run").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    return runs.groupBy("match_id").agg(F.min("a").alias("begin"), F.max("b").alias("end"), F.array_sort(F.collect_list(F.struct("a", "b"))).alias("ranges"))


def stands_alone(tokens: DataFrame, found: DataFrame) -> DataFrame:
    """found (sent_id, first, last, ...) bounded on both sides by punctuation or the sentence's edge."""
    edge = tokens.select("sent_id", "i", "punct")
    before, after = edge.select("sent_id", (F.col("i") + 1).alias("first"), F.col("punct").alias("pb")), edge.select("sent_id", (F.col("i") - 1).alias("last"), F.col("punct").alias("pa"))
    rows = found.join(before, ["sent_id", "first"], "left").join(after, ["sent_id", "last"], "left")
    return rows.where(F.coalesce("pb", F.lit(True)) & F.coalesce("pa", F.lit(True))).select(*found.columns)


def documents(found_words: DataFrame, found_spans: DataFrame, sentences: DataFrame) -> DataFrame:
    """(doc_id, tokens, spans): all words and spans of each document in order, from sentences (doc_id, sent_id)."""
    w = sentences.join(found_words, "sent_id").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sent_id", "i", "lower", "lemma", "cefr", "unknown"))).alias("tokens"))
    s = sentences.join(found_spans, "sent_id").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("begin", "end", "match_id"))).alias("spans"))
    return w.join(s, "doc_id", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<begin:int,end:int,match_id:bigint>>")))


def recall(gold: DataFrame, found: DataFrame, compiled: DataFrame) -> DataFrame:
    """(outcome, n): what became of gold items (gold_id, item_id, sent_id, first, last): found exactly, overlapped, not compiled or missed."""
    f = found.select("item_id", "sent_id", F.col("first").alias("f"), F.col("last").alias("l"))
    g = gold.join(f, ["item_id", "sent_id"], "left").join(compiled.select("item_id", F.lit(True).alias("c")).distinct(), "item_id", "left")
    best = F.max(F.when((F.col("f") == F.col("first")) & (F.col("l") == F.col("last")), 3).when((F.col("f") <= F.col("last")) & (F.col("l") >= F.col("first")), 2).when(F.col("c"), 0).otherwise(1))
    rank = g.groupBy("gold_id").agg(best.alias("r"))
    name = F.when(F.col("r") == 3, "exact").when(F.col("r") == 2, "words").when(F.col("r") == 1, "not compiled").otherwise("not found")
    return rank.groupBy(name.alias("outcome")).agg(F.count("*").alias("n"))


def stratified(sample: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row (precision): the mean of right over strata, each weighted by its size; sample is (tier, right), sizes (tier, n)."""
    p = sample.groupBy("tier").agg(F.avg(F.col("right").cast("double")).alias("p")).join(sizes, "tier")
    return p.agg((F.sum(F.col("p") * F.col("n")) / F.sum("n")).alias("precision"))
