"""The Porter stemmer, as rules over measured stems."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import types as T

from lexlake.functions.text import by_distinct

_FORM = re.compile(r"[aeiou]")


def _shape(word: str) -> str:
    """c for consonants and v for vowels; y is a vowel after a consonant."""
    out = ""
    for i, c in enumerate(word):
        out += "v" if c in "aeiou" or c == "y" and i and out[-1] == "c" else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _cvc(stem: str) -> bool:
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


# Suffix pairs of the published algorithm, and the least measure of their stems.
STEP2 = (
    "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate "
    "alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble logi:log"
)
STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _table(pairs: str) -> list[tuple[str, str]]:
    return sorted((tuple(p.split(":")) for p in pairs.split()), key=lambda p: -len(p[0]))


_STEPS = (_table(STEP2), _table(STEP3))
_LAST = sorted(STEP4.split(), key=len, reverse=True)


@lru_cache(maxsize=100_000)
def porter(word: str) -> str:
    """The stem of a lower-case word; words of two letters or fewer stay."""
    if len(word) <= 2:
        return word
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            stem = word.removesuffix(suffix)
            if stem != word:
                if "v" in _shape(stem):
                    word = stem
                    if word.endswith(("at", "bl", "iz")):
                        word += "e"
                    elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
                        word = word[:-1]
                    elif _measure(word) == 1 and _cvc(word):
                        word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for step in _STEPS:
        for suffix, to in step:
            if word.endswith(suffix):
                if _measure(word[: -len(suffix)]) > 0:
                    word = word[: -len(suffix)] + to
                break
    for suffix in _LAST:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                word = stem
            break
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or m == 1 and not _cvc(word[:-1]):
            word = word[:-1]
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stems(text: str) -> list[str]:
    return [porter(w) for w in re.findall(r"[a-z0-9]+", text.lower())]


stem = by_distinct(porter, T.StringType())
stem_list = by_distinct(stems, T.ArrayType(T.StringType()))
