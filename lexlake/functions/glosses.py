"""Terms and character pairs of Chinese glosses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A term of more characters is a sentence.
MAX_TERM = 16
#: Character pairs kept for each word.
MAX_BIGRAMS = 60
CJK = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]"
NOTES = r"[（(【\[〔〈][^）)】\]〕〉]*[）)】\]〕〉]"
OUTER = " .。…～~:：\"'“”‘’`"


def zh_terms(gloss: Column) -> Column:
    """The terms of a gloss in order, each once: notes in brackets dropped, split at separators."""
    parts = F.split(F.regexp_replace(gloss, NOTES, " "), "[；;，,、/|]")
    terms = F.filter(F.transform(parts, lambda p: F.btrim(p, F.lit(OUTER))), lambda t: t.rlike(CJK) & (F.length(t) <= MAX_TERM))
    return F.array_distinct(terms)


def gloss_bigrams(gloss: Column) -> Column:
    """Each two neighbouring ideographs of a gloss in order, each once; a lone one stands for itself."""
    runs = F.regexp_extract_all(F.regexp_replace(gloss, NOTES, " "), F.lit(f"({CJK}+)"), 1)
    pairs = F.transform(
        runs,
        lambda r: F.when(F.length(r) == 1, F.array(r)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substr(r, i, F.lit(2)))),
    )
    return F.array_distinct(F.flatten(pairs))
