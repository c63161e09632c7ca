"""Printed examples and translations as plain text, and their sentences."""

from __future__ import annotations

import re

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexlake.functions.text import by_distinct

ABBREVIATIONS = ("approx", "a.m", "dr", "e.g", "etc", "fig", "i.e", "jr", "mr", "mrs", "ms", "no", "p.m", "prof", "sr", "st", "u.k", "u.s", "vs")
#: Labels of style and use that dictionaries print in brackets before an example.
STYLES = ("approving", "archaic", "dated", "derogatory", "disapproving", "figurative", "formal", "humorous", "informal", "ironic", "literary", "offensive", "old-fashioned", "rare", "slang", "spoken", "technical", "written")
#: What text begins with: a letter, a decimal digit, an opening bracket or quote, a currency sign, or a
#: sign with a number after it. Bullets, circled numbers, arrows and closing marks aren't text.
_START = regex.compile(r"[\p{L}\p{M}\p{Nd}_\p{Ps}\p{Pi}\p{Sc}\"'`.…]|[\p{Pd}+−±＋#＃](?=\p{Sc}?[.,]?\p{Nd})")
_LABEL = regex.compile(r"[〈<]\p{Han}{1,4}[〉>]")
#: Notes that aren't part of an example, at its beginning and anywhere.
_FIRST = regex.compile(rf"\p{{Nd}}{{1,2}}\)|[a-z]\)|\[[^\]]{{1,40}}\]\s*:?|\((?:{'|'.join(STYLES)})\)|\(\s*[+~][^)]{{0,40}}\)")
_ANYWHERE = regex.compile(r"\((?:=|i\.?e\.?\s|e\.?g\.?\s)[^)]*\)|\[(?:w?=|(?:with|no) obj)[^\]]{0,40}\]")


def from_text(text: str) -> str:
    """A text from its first character that is text."""
    found = _START.search(text)
    return text[found.start() :] if found else ""


def english(text: str) -> str:
    """The English side without bullets, Chinese labels and the notes of a dictionary."""
    rest = regex.sub(r"\s*或\s*", " or ", _LABEL.sub(" ", text))
    rest = from_text(" ".join(_ANYWHERE.sub(" ", rest).split()))
    while note := _FIRST.match(rest):  # notes stand in chains, with bullets between
        rest = from_text(rest[note.end() :].lstrip())
    return regex.sub(r"(?<=\w) +(?=[.,?!;:](?:\s|$))", "", rest)


def chinese(text: str) -> str:
    """The Chinese side without labels, subjects and leading marks."""
    rest = regex.sub(r"^\s*【\p{Han}{1,6}】", "", _LABEL.sub("", from_text(text)))
    return from_text(" ".join(rest.split()))


def sentences(text: str) -> list[str]:
    """English sentences; an abbreviation or an initial ends none."""
    out, begin = [], 0
    for m in re.finditer(r"[.?!]+[\"'”’)]*\s+(?=[\"'“‘(]?[A-Z0-9])", text):
        word = re.search(r"([\w.]*)[.?!]+[\"'”’)]*\s+$", text[begin : m.end()])
        if word and m[0].startswith(".") and (word[1].lower() in ABBREVIATIONS or re.fullmatch("[A-Z]", word[1])):
            continue
        out.append(text[begin : m.end()].strip())
        begin = m.end()
    return [*out, text[begin:].strip()] if text[begin:].strip() else out


clean_english = by_distinct(english, T.StringType())
clean_chinese = by_distinct(chinese, T.StringType())
sentence_list = by_distinct(sentences, T.ArrayType(T.StringType()))


def is_english_sentence(c: Column) -> Column:
    """Four words or more, two of them lower case, an end, and no placeholders."""
    return (F.regexp_count(c, F.lit(r"[A-Za-z]+(?:['’-][A-Za-z]+)*")) >= 4) & c.rlike(r"[.?!][\"'”’)]*\s*$") & ~c.rlike(r"\b(?:sb|sth)\b") & (F.regexp_count(c, F.lit(r"\b[a-z]+\b")) >= 2)


def is_chinese_sentence(c: Column, strict: bool = True) -> Column:
    enough = F.regexp_count(c, F.lit(r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]")) >= 4
    return enough & c.rlike("[。？！]") if strict else enough


def paragraphs(c: Column, least: int = 8) -> Column:
    """Paragraphs of at least so many words, without what a library prints around a book."""
    body = F.regexp_replace(F.regexp_replace(c, r"(?s)^.*?\*\*\* ?START OF[^\n]*\n", ""), r"(?s)\*\*\* ?END OF.*$", "")
    parts = F.transform(F.split(body, r"\n\s*\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    return F.filter(parts, lambda p: F.size(F.split(p, " ")) >= least)
