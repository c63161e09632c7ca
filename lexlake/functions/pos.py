"""Printed parts of speech as tags and features."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import types as T

from lexlake.functions.text import by_distinct

# Printed words for each tag, and for each feature.
TAGS = {
    "NOUN": "noun n n. nouns substantive nn 名词 npl npl. pl.n. pl. plural pluralnoun colour color", "VERB": "verb v v. vb vb. link aux auxiliary modal vt vt. tr. tr.v. transitive vi vi. intr intr. intr.v. intransitive 动词 v-link v-erg aux.v. v.aux.",
    "ADJ": "adjective adj adj. a. 形容词 adj-graded modifier colour color", "ADV": "adverb adv adv. ad. 副词 adv-graded connector connective", "ADP": "preposition prep prep. 介词", "CCONJ": "conjunction conj conj. 连词 conj-coord",
    "SCONJ": "conj-subord subordinating", "PRON": "pronoun pron pron. 代词 quest", "DET": "determiner det det. article predeterminer quantifier quant art. 限定词", "INTJ": "interjection interj interj. int. exclamation exclam 感叹词", "NUM": "number num num. numeral cardinal ordinal fraction 数词",
    "PROPN": "proper geographical biographical n-proper trademark", "SYM": "symbol", "PART": "infinitive neg", "X": "abbreviation abbr abbr. abbrev. acronym contraction short 缩写 prefix pref. suffix suff. combining foreign",
}
FEATURES = {
    ("Number", "Plur"): "npl npl. pl.n. pl. plural pluralnoun", ("Number", "Sing"): "sing singular sing.", ("Countability", "Count"): "count countable c", ("Countability", "Mass"): "uncount uncountable noncount mass u",
    ("Transitivity", "Transitive"): "vt vt. tr. tr.v. transitive t", ("Transitivity", "Intransitive"): "vi vi. intr intr. intr.v. intransitive i", ("Kind", "Abbreviation"): "abbreviation abbr abbr. abbrev. acronym contraction short 缩写",
    ("Kind", "Prefix"): "prefix pref.", ("Kind", "Suffix"): "suffix suff.", ("Kind", "CombiningForm"): "combining", ("Kind", "Phrase"): "phrase phr phr. phrasal", ("Kind", "Trademark"): "trademark", ("Kind", "Modifier"): "modifier", ("Kind", "Connector"): "connector connective",
}
_TAG_OF: dict[str, list[str]] = {}
_FEATURE_OF: dict[str, list[tuple[str, str]]] = {}
for _tag, _words in TAGS.items():
    for _w in _words.split():
        _TAG_OF.setdefault(_w, []).append(_tag)
for _feature, _words in FEATURES.items():
    for _w in _words.split():
        _FEATURE_OF.setdefault(_w, []).append(_feature)
POS = T.StructType([T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("features", T.MapType(T.StringType(), T.StringType()))])


def _parts(printed: str) -> Iterator[str]:
    for token in re.split(r"[\s,;&/+()]+", printed.strip().lower()):
        token = re.sub(r"(?<=\D)\d+$", "", token)
        if token in _TAG_OF or token in _FEATURE_OF:
            yield token
        else:  # codes joined by hyphens
            yield from (p for p in token.split("-") if p in _TAG_OF or p in _FEATURE_OF)


def read(printed: str) -> dict:
    """The tags, in order, and features of a printed part of speech; two values of one feature are Both."""
    tags: set[str] = set()
    features: dict[str, str] = {}
    for part in _parts(printed):
        tags.update(_TAG_OF.get(part, ()))
        for name, value in _FEATURE_OF.get(part, ()):
            features[name] = value if features.get(name, value) == value else "Both"
    if "SCONJ" in tags:
        tags.discard("CCONJ")
    if "PROPN" in tags or "X" in tags and features.get("Kind") in ("Prefix", "Suffix", "CombiningForm"):
        tags.discard("NOUN")
    return {"tags": sorted(tags), "features": features}


pos_of = by_distinct(read, POS)
