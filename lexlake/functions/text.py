"""Text functions: native column expressions where Spark has them, Arrow functions elsewhere."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stress marks and syllable dots, printed in headwords but no part of the word.
PRINTED_MARKS = "ˈˌ·‧•"
# Quotes and dashes that are typed in several ways.
QUOTE_FORMS = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "‐": "-", "‑": "-", "´": "'", "`": "'"}
ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def by_distinct(f: Callable[[str], object], kind: T.DataType) -> Callable[..., Column]:
    """An Arrow function that calls f once for each different text of a batch; null stays null, in
    structs as null fields."""
    if isinstance(kind, T.StructType):
        names = kind.fieldNames()

        @F.pandas_udf(kind)
        def fields(texts: pd.Series) -> pd.DataFrame:
            codes, values = pd.factorize(texts, use_na_sentinel=True)
            results = [f(v) for v in values]
            return pd.DataFrame([results[c] if c >= 0 else dict.fromkeys(names) for c in codes], columns=names, dtype=object)

        return fields

    @F.pandas_udf(kind)
    def apply(texts: pd.Series) -> pd.Series:
        codes, values = pd.factorize(texts, use_na_sentinel=True)
        results = [f(v) for v in values]
        return pd.Series([results[c] if c >= 0 else None for c in codes], dtype=object)

    return apply


def lookup_form(headword: str) -> str:
    """NFKC, case and accents folded, printed marks dropped, white space collapsed."""
    bare = "".join(c for c in headword if c not in PRINTED_MARKS)
    apart = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", bare).casefold())
    return " ".join(unicodedata.normalize("NFC", "".join(c for c in apart if not unicodedata.combining(c))).split())


def path_form(path: str) -> str:
    """A resource path as it is looked up: NFC, forward slashes, no leading ./ or /, lower case."""
    return re.sub(r"^(?:\./|/)+", "", unicodedata.normalize("NFC", path).replace("\\", "/")).lower()


def english_form(text: str) -> str:
    folded = unicodedata.normalize("NFKC", text)
    return " ".join("".join(QUOTE_FORMS.get(c, c) for c in folded).casefold().split())


def chinese_form(text: str) -> str:
    return "".join(english_form(text).split())


def one_edit(word: str) -> list[str]:
    """All strings one deletion, swap, change or insertion of a letter away from word."""
    out = set()
    for i in range(len(word) + 1):
        head, tail = word[:i], word[i:]
        if tail:
            out.add(head + tail[1:])
            out.update(head + c + tail[1:] for c in ALPHABET)
        if len(tail) > 1:
            out.add(head + tail[1] + tail[0] + tail[2:])
        out.update(head + c + tail for c in ALPHABET)
    return sorted(out - {word, ""})


norm = by_distinct(lookup_form, T.StringType())
norm_path = by_distinct(path_form, T.StringType())
norm_en = by_distinct(english_form, T.StringType())
norm_zh = by_distinct(chinese_form, T.StringType())
edits1 = by_distinct(one_edit, T.ArrayType(T.StringType()))


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two texts; null if either is."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype=float)


def ratio_from(a: Column, b: Column, least: float) -> Column:
    """ratio where it is at least least, null elsewhere; by common letters, whose share ratio never exceeds, most pairs are left out."""

    @F.pandas_udf(T.DoubleType())
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        letters = {x: Counter(x) for x in {*a, *b} if x is not None}
        out = []
        for x, y in zip(a, b):
            r = None
            if x is not None and y is not None:
                common, size, has = 0, len(x) + len(y), letters[y]
                for c, n in letters[x].items():
                    common += min(n, has[c])
                if not size or 2.0 * common / size >= least:
                    r = SequenceMatcher(None, x, y).ratio()
            out.append(r if r is not None and r >= least else None)
        return pd.Series(out, dtype=float)

    return scored(a, b)


def collapsed(c: Column) -> Column:
    """White space of any kind collapsed to single spaces and trimmed."""
    return F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " "))


def only_content(c: Column) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}]", "")


def exact_key(en: Column, zh: Column) -> Column:
    return F.concat_ws("\t", F.lower(collapsed(en)), F.regexp_replace(F.lower(zh), r"[\s\p{Z}]+", ""))


def loose_key(en: Column, zh: Column) -> Column:
    return F.concat_ws("\t", only_content(F.lower(en)), only_content(F.lower(zh)))


def has_cjk(c: Column) -> Column:
    return c.rlike(r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]")


def without_tags(html: Column) -> Column:
    """Visible text: tags become spaces, the common entities their characters."""
    bare = F.regexp_replace(html, r"<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return collapsed(bare)


def plain(html: Column, limit: int = 160) -> Column:
    text = without_tags(html)
    return F.when(F.length(text) > limit, F.concat(F.rtrim(F.substring(text, 1, limit)), F.lit("…"))).otherwise(text)


def linked_names(html: Column) -> Column:
    """File names in src and href attributes, without their folders, in order, each once."""
    refs = F.regexp_extract_all(html, F.lit(r"""(?:src|href)\s*=\s*["']([^"']+)["']"""), 1)
    return F.array_distinct(F.transform(refs, lambda x: F.element_at(F.split(x, r"[/\\]"), -1)))


def split_en_zh(c: Column) -> tuple[Column, Column]:
    """English and Chinese of a text: cut at the first ideograph, an opening bracket goes with it."""
    at = r"^(.*?)([(（\[【“‘《〈]*[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}].*)$"
    has = has_cjk(c)
    return F.trim(F.when(has, F.regexp_extract(c, at, 1)).otherwise(c)), F.trim(F.when(has, F.regexp_extract(c, at, 2)).otherwise(F.lit("")))


def strip_slashes(ipa: Column) -> Column:
    return F.btrim(ipa, F.lit("/[] "))


def _no_vowels(word: Column) -> Column:
    return F.concat(F.left(word, F.lit(1)), F.regexp_replace(F.substr(word, F.lit(2)), "[aeiouy]+", ""))


def skeleton(word: Column) -> Column:
    """First letter and consonants of a word in its consonant spelling."""
    return _no_vowels(consonant_spelling(word))


def consonant_spelling(word: Column) -> Column:
    """The word with c, k and q, with ph and f, and with doubled letters written as one."""
    w = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(word), "ck|[cq]", "k"), "ph", "f"), r"(.)\1", "$1")
    return w


def spelled_alike(a: Column, b: Column) -> Column:
    """Two spellings of one word: equal in consonant spelling, or equal in consonants though spelled with others.

    Both have four letters or more, nearly the same length and the same end; one that begins with
    the other is a word with an ending.
    """
    shape = (F.least(F.length(a), F.length(b)) >= 4) & (F.abs(F.length(a) - F.length(b)) <= 2) & (F.right(a, F.lit(1)) == F.right(b, F.lit(1)))
    respelt = (skeleton(a) == skeleton(b)) & (_no_vowels(F.lower(a)) != _no_vowels(F.lower(b)))
    return (a != b) & shape & ~a.startswith(b) & ~b.startswith(a) & ((consonant_spelling(a) == consonant_spelling(b)) | respelt)


def syllables(word: Column) -> Column:
    """Vowel groups, a silent final e aside, one at least."""
    groups = F.regexp_count(F.lower(word), F.lit("[aeiouy]+"))
    silent = F.lower(word).rlike("[^aeiouyl]e$") & (groups > 1)
    return F.greatest(groups - silent.cast("int"), F.lit(1))


def human_size(c: Column) -> Column:
    kb, mb, gb = 1024.0, 1024.0**2, 1024.0**3
    return (
        F.when(c >= gb, F.concat(F.format_string("%.2f", c / gb), F.lit(" GB")))
        .when(c >= mb, F.concat(F.format_string("%.1f", c / mb), F.lit(" MB")))
        .when(c >= kb, F.concat(F.format_string("%.0f", c / kb), F.lit(" KB")))
        .otherwise(F.concat(c.cast("string"), F.lit(" B")))
    )


def strip_ext(name: Column) -> Column:
    """A file name without the extension of a dictionary, a numbered volume or an archive."""
    return F.regexp_replace(name, r"(?i)(?:\.\d+)?\.(?:mdx|mdd|css|js|zip|rar|7z|tar|gz)$", "")


def volume(name: Column) -> Column:
    """The number of a numbered volume, 0 of the unnumbered one, null of other files."""
    return F.when(name.rlike(r"(?i)\.\d+\.mdd$"), F.regexp_extract(name, r"(?i)\.(\d+)\.mdd$", 1).cast("int")).when(name.rlike(r"(?i)\.mdd$"), F.lit(0))


def escape_html(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def length_distance(chars: Column, words: Column, typical: float = 1.545) -> Column:
    """How far the ratio of characters to words is from the typical one, as a logarithm."""
    return F.when((chars > 0) & (words > 0), F.abs(F.log(chars / words / typical))).otherwise(F.lit(float("inf")))
