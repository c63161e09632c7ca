"""What dictionaries mark in their markup: levels of words, misspellings, words that are confused."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Level = tuple[str, str, str, int]  # part of speech, scheme, value, senses
LEVELS = T.ArrayType(T.StructType([T.StructField("pos", T.StringType()), T.StructField("scheme", T.StringType()), T.StructField("value", T.StringType()), T.StructField("senses", T.IntegerType())]))
# The values of each scheme.
SCHEMES = {
    "oxford3000": "a1 a2 b1 b2", "oxford5000": "b2 c1", "cefr": "a1 a2 b1 b2 c1 c2", "opal": "written spoken", "academic": "yes", "core": "high medium low", "spoken": "S1 S2 S3", "written": "W1 W2 W3", "awl": "yes",
    "frequency_band": "1 2 3 4 5", "stars": "1 2 3", "oed_band": "1 2 3 4 5 6 7 8",
}
CORE = {"High-frequency": "high", "Medium-frequency": "medium", "Lower-frequency": "low"}


def _pos(markup: str) -> str:
    m = re.search(r'class="pos"[^>]*>([^<]*)<', markup)
    return m[1].strip() if m else ""


def symbols(markup: str) -> Iterator[Level]:
    """Marks in symbols of the head and in attributes of the senses; each head of a page is an entry."""
    for part in re.split(r"(?=<h1\b)", markup):
        if not part.startswith("<h1"):
            continue
        head, _, senses = part.partition("<ol")
        for size, value in re.findall(r"ox([35])ksym_([abc][12])", head):
            yield _pos(head), f"oxford{size}000", value, 0
        tag = part[: part.find(">")]
        for kind in ("written", "spoken"):
            if f'opal_{kind}="y"' in tag:
                yield _pos(head), "opal", kind, 0
        if 'academic="y"' in tag:
            yield _pos(head), "academic", "yes", 0
        for value, n in sorted(Counter(re.findall(r'<li class="sense"[^>]*\bcefr="([abc][12])"', senses)).items()):
            yield _pos(head), "cefr", value, n


def bands(markup: str) -> Iterator[Level]:
    """Core vocabulary, spoken and written bands, academic words; a mark that isn't known raises."""
    for head in re.findall(r'<span class="entryhead">(.*?)(?=<span class="entryhead">|class="Sense"|$)', markup, re.S):
        for name in re.findall(r'title="Core vocabulary: ([\w-]+)"', head):
            if name not in CORE:
                raise ValueError(f"unknown core vocabulary {name!r}")
            yield _pos(head), "core", CORE[name], 0
        for kind, n in re.findall(r'class="freq"[^>]*>([A-Z])(\d)<', head):
            if kind not in "SW" or n not in "123":
                raise ValueError(f"unknown band {kind}{n}")
            yield _pos(head), "spoken" if kind == "S" else "written", kind + n, 0
        if 'title="Academic Word List"' in head:
            yield _pos(head), "awl", "yes", 0


def dots(markup: str) -> Iterator[Level]:
    """One frequency for the word: the filled dots of five."""
    found = re.findall(r'class="level level\d( roundRed)?\s*"', markup)[:5]
    if len(found) == 5 and any(found):
        yield "", "frequency_band", str(sum(map(bool, found))), 0


def stars(markup: str) -> Iterator[Level]:
    m = re.search(r'class="stars"[^>]*>(★+)', markup)
    if m:
        yield _pos(markup), "stars", str(len(m[1])), 0


def frequency(markup: str) -> Iterator[Level]:
    m = re.search(r'data-band="([1-8])"', markup)
    if m:
        yield "", "oed_band", m[1], 0


READERS: dict[str, Callable[[str], Iterator[Level]]] = {"symbols": symbols, "bands": bands, "dots": dots, "stars": stars, "frequency": frequency}


def levels(entries: DataFrame, reader: str) -> DataFrame:
    """(id, pos, scheme, value, senses) of entries (id, body), each different body read once for a batch."""
    from lexlake.functions.text import by_distinct

    read = by_distinct(lambda m: [dict(zip(("pos", "scheme", "value", "senses"), x)) for x in READERS[reader](m)], LEVELS)
    return entries.select("id", F.explode(read("body")).alias("l")).select("id", "l.*")


# Confusions and misspellings, stated in plain text.

WRONG = re.compile(r"(?i)do not (?:write|spell|say):? ([A-Za-z' -]+?)(?:[.;!]|$)|(?:often|sometimes) misspelled as ([A-Za-z' -]+?)(?:[.;!]|$)")
CONFUSED = re.compile(r"[Dd]o not confuse (?:(?:this word|it) with )?([\w' -]+?)(?:[.;!]|$)|[Ww]hich [Ww]ord\?\s*([\w' /|-]+?)(?:[.;!]|$)|[Cc]ompare ([\w', -]+?)(?:[.;!]|$)")


def misspellings(headword: str, text: str) -> list[str]:
    """Wrong spellings of a headword that a text warns of: ones that begin like it and are much like it."""
    out = []
    for m in WRONG.finditer(text):
        for word in re.split(r"\s*(?:,|\bor\b)\s*", m[1] or m[2]):
            w = word.strip().lower()
            if w and w != headword.lower() and w[:3] == headword.lower()[:3] and SequenceMatcher(None, w, headword.lower()).ratio() >= 0.8:
                out.append(w)
    return list(dict.fromkeys(out))


def confused(headword: str, text: str) -> list[str]:
    """Words that a text sets beside the headword, of three parts at most, in order."""
    out = [headword.lower()]
    for m in CONFUSED.finditer(text):
        for word in re.split(r"\s*(?:,|/|\||\band\b|\bor\b|\bwith\b)\s*", next(g for g in m.groups() if g)):
            w = " ".join(word.lower().split())
            if w and len(w.split()) <= 3 and not any(c.isdigit() for c in w):
                out.append(w)
    out = list(dict.fromkeys(out))
    return out if len(out) > 1 else []


def stated(entries: DataFrame, lexicon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(misspellings (word, wrong, n), confusions (words, n)) of entries (dict_id, headword, text): what n dictionaries state.

    A misspelling that is a word of the lexicon (word) is none; of a confusion only known words stay.
    """
    from lexlake.functions.text import by_distinct

    join = F.concat_ws("\x1f", "headword", "text")
    rows = entries.where("headword is not null and text is not null").select("dict_id", F.lower("headword").alias("word"), join.alias("j"))
    wrong = by_distinct(lambda j: misspellings(*j.split("\x1f", 1)), T.ArrayType(T.StringType()))
    sets = by_distinct(lambda j: confused(*j.split("\x1f", 1)), T.ArrayType(T.StringType()))
    known = lexicon.select(F.lower("word").alias("w")).distinct()
    m = rows.select("dict_id", "word", F.explode(wrong("j")).alias("wrong")).join(known, F.col("wrong") == F.col("w"), "left_anti")
    c = rows.withColumn("id", F.xxhash64("dict_id", "j")).select("dict_id", "id", F.posexplode(sets("j")).alias("at", "w")).distinct().join(known, "w", "left_semi")
    c = c.groupBy("dict_id", "id").agg(F.array_sort(F.collect_set("w")).alias("words")).where("size(words) > 1")
    return m.groupBy("word", "wrong").agg(F.count_distinct("dict_id").alias("n")), c.groupBy("words").agg(F.count_distinct("dict_id").alias("n"))
