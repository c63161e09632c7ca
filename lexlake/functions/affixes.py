"""English affixes by what they make, and how endings join words.

The rules of joining are those of spelling: a mute e goes, y becomes i, a consonant is doubled, and
before endings of Latin verbs d and de become s.
"""

from __future__ import annotations

from functools import lru_cache

NOUN = ("age", "al", "ance", "ancy", "ant", "arian", "ary", "ation", "ator", "cy", "dom", "ee", "eer", "ence", "ency", "ent", "er", "ery", "ess", "ette", "hood", "ian", "ics", "ing", "ion", "ism", "ist", "ition", "ity", "let", "ling", "ment", "ness", "ology", "or", "ory", "ry", "ship", "sion", "ster", "t", "th", "tion", "ty", "ure", "y")
ADJECTIVE = ("able", "al", "an", "ant", "ary", "ative", "ed", "en", "ent", "ern", "ese", "esque", "ful", "ial", "ible", "ic", "ical", "ile", "ine", "ing", "ish", "itive", "ive", "less", "like", "ly", "ory", "ous", "some", "ual", "worthy", "y")
VERB = ("ate", "en", "ify", "ise", "ize")
ADVERB = ("fold", "ly", "ward", "wards", "ways", "wise")
INFLECTION = ("s", "es", "ed", "d", "ing", "er", "est", "en")
#: Beginnings by what they mean.
PREFIX = {
    "not": ("a", "an", "dis", "il", "im", "in", "ir", "non", "un"), "against": ("anti", "contra", "counter"), "badly": ("mal", "mis"), "again": ("re",), "away": ("ab", "de", "ex"),
    "place": ("circum", "extra", "fore", "inter", "intra", "mid", "out", "over", "sub", "super", "sur", "trans", "under", "up"), "time": ("ante", "neo", "post", "pre"),
    "number": ("bi", "demi", "di", "mono", "multi", "poly", "semi", "tri", "uni"), "size": ("hyper", "macro", "mega", "micro", "mini", "ultra"),
    "with": ("co", "col", "com", "con", "syn"), "for": ("pro",), "self": ("auto", "self"), "make": ("be", "em", "en"), "false": ("pseudo", "quasi"),
}
SUFFIXES = tuple(sorted({*NOUN, *ADJECTIVE, *VERB, *ADVERB, *INFLECTION}, key=lambda s: (-len(s), s)))
PREFIXES = tuple(sorted({p for own in PREFIX.values() for p in own}, key=lambda p: (-len(p), p)))
#: Letters that a stem must keep.
LEAST = 3


def unjoined(stem: str, ending: str) -> set[str]:
    """The words that, with this ending joined to them, may have left this stem."""
    out = {stem}
    if ending[0] in "aeiouy":
        out.add(stem + "e")
        if len(stem) > 2 and stem[-1] == stem[-2] and stem[-1] not in "aeiou":
            out.add(stem[:-1])
    if stem.endswith("i"):
        out.add(stem[:-1] + "y")
    if ending in ("ion", "ive", "ory") and stem.endswith("s"):
        out |= {stem[:-1] + "d", stem[:-1] + "de", stem[:-1] + "t"}
    if ending in ("ity", "al", "ic", "ical", "ous", "ist", "ism", "ian", "ize", "ise", "ify", "ian"):
        out |= {stem + "y", stem + "ic"}
    if ending in ("ation", "ative", "ator", "able", "ance", "ant", "ancy", "or", "ion"):
        out.add(stem + "ate")
    if ending == "y" or ending.endswith("cy"):
        out |= {stem + "t", stem + "te"}
    return out


@lru_cache(maxsize=200_000)
def stems(word: str, depth: int = 3) -> frozenset[str]:
    """The words from which suffixes, up to depth of them one after the other, may have made this one."""
    out: set[str] = set()
    for s in SUFFIXES:
        rest = word[: -len(s)]
        if word.endswith(s) and len(rest) >= LEAST - 1:
            for base in unjoined(rest, s):
                if len(base) >= LEAST:
                    out.add(base)
                    if depth > 1:
                        out |= stems(base, depth - 1)
    return frozenset(out - {word})
