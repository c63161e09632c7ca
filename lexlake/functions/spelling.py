"""British and American spellings of one word, as chains of native replacements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Difference:
    """Letters that differ: British and American ones, what must stand before them, and the endings that may follow."""

    british: str
    american: str
    before: str = ""
    after: tuple[str, ...] = ("", "s")

    @property
    def pattern(self) -> str:
        tail = "" if not self.after else "(?=(?:" + "|".join(sorted(self.after, reverse=True)) + ")$)"
        return (f"(?<={self.before})" if self.before else "") + self.british + tail


VERB = ("", "d", "s", "r", "rs")
#: The classes into which descriptions of the two spellings sort the differences.
DIFFERENCES = (
    Difference("our", "or", "[a-z]{2}", ("", "s", "ed", "ing", "er", "ers", "able", "ful", "fully", "less", "ist", "ite", "ites", "hood")),  # colour
    Difference("re", "er", "[bcdghptv]", ("", "s", "d")),  # centre
    Difference("is", "iz", "[a-z]{2}", ("e", "ed", "es", "er", "ers", "ing", "able", "ation", "ations")),  # organise
    Difference("ys", "yz", "l", ("e", "ed", "es", "er", "ers", "ing")),  # analyse
    Difference("ogue", "og", "[a-z]"),  # catalogue
    Difference("ence", "ense", "[a-z]{2}"),  # licence
    Difference("amme", "am", "[a-z]"),  # programme
    Difference("[ao]e", "e", "[a-z]", ()),  # anaemia, foetus
    Difference("[ao]e", "e", "^", ("[a-z]{3,}",)),  # aesthetic
    Difference("gement", "gment", "d"),  # judgement
    Difference("xion", "ction", "e"),  # connexion
    Difference("ll", "l", "[aeiou]", ("", "s", "ed", "ing", "er", "ers", "or", "ors", "ment", "ments")),  # traveller; fulfil and fulfill
    Difference("grey", "gray", "", ("", "s", "er", "est", "ing", "ish")),
)


def american(word: Column) -> Column:
    """A word with the British letters of every class turned into the American ones."""
    for d in DIFFERENCES:
        word = F.regexp_replace(word, d.pattern, d.american)
    return word


def variant_key(word: Column) -> Column:
    """Equal for two spellings of one word; case, spaces and hyphens don't count."""
    return american(F.regexp_replace(F.lower(word), r"[\s\p{Pd}]+", ""))


def is_variant(form: Column, lemma: Column) -> Column:
    return (form != lemma) & (variant_key(form) == variant_key(lemma))


def regions(a: Column, b: Column) -> Column:
    """STRUCT<a, b>: GB and US where a difference of one class tells the two spellings apart, else empty."""

    def turned(x: Column, y: Column) -> Column:
        return F.exists(F.array(*(F.regexp_replace(x, d.pattern, d.american) for d in DIFFERENCES)), lambda z: (z != x) & (z == y))

    first = F.when(turned(a, b), "GB").when(turned(b, a), "US").otherwise("")
    second = F.when(first == "GB", "US").when(first == "US", "GB").otherwise("")
    return F.struct(first.alias("a"), second.alias("b"))
