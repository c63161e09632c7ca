"""Problem 3: the language of documents, of segments, of sides of pairs and of catalog names.

A text is compressed with one zstandard raw-content dictionary for each language that its scripts
leave and takes the language whose dictionary makes it smallest; where the margin over the next is
narrow, it takes none. Where the scripts leave one language, the text without a dictionary is the
next: a text that the dictionary doesn't help with is in a language that isn't listed, or in none. The dictionaries are fitted on a bounded sample of labelled rows. As labels are noisy, a
sentence goes into a dictionary only if the words of the whole sample agree with its label.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents, sides and names for each label in the training sample; sentences of each document.
SAMPLE_ROWS, SAMPLE_SENTENCES = 400, 24
#: Bytes of a dictionary; levels of the compressor, the second for texts whose margin is narrow at the first.
DICT_BYTES, LEVELS = 192 * 1024, (1, 12)
#: Least margin: bytes, and share of the bytes of the text.
LEAST_BYTES, LEAST_SHARE = 3, 0.06
#: A segment of fewer words (ideographs) is no sentence. Longer ones than LONG characters are also
#: read in blocks of BLOCK.
LEAST_WORDS, LONG, BLOCK = 4, 220, 90
#: Confidence from which the blocks of a long text speak for the whole.
CLEAR = 0.4
#: How much better, as a logarithm, the words of a training sentence must fit its label than others.
AGREE = 1.0

# The languages of the corpus, with the notations of each.
NOTATIONS = {
    "en": "en eng english anglais englisch inglés 英语 英文",
    "zh": "zh zho chi cmn chinese mandarin chinois chinesisch 中文 汉语 漢語 zh-hans zh-hant",
    "de": "de deu ger german deutsch allemand 德语",
    "fr": "fr fra fre french français francais französisch 法语",
    "es": "es spa spanish español espanol castellano 西班牙语",
    "it": "it ita italian italiano 意大利语",
    "nl": "nl nld dut dutch nederlands 荷兰语",
    "ja": "ja jpn jp japanese 日本語 日语",
    "ru": "ru rus russian русский 俄语",
}
CODES = {n: code for code, names in NOTATIONS.items() for n in names.split()}
NAME_CLASSES = ("en-en", "en-zh", "en-other", "other")


def code_of(label: str | None) -> str | None:
    """The language that a label names, in whatever notation; None if it names none."""
    if not label:
        return None
    text = unicodedata.normalize("NFKC", label).strip().casefold().replace("_", "-")
    return CODES.get(text) or CODES.get(re.split(r"[-\s(]", text)[0])


def label_code(label: Column) -> Column:
    """code_of as an expression."""
    text = F.replace(F.lower(F.trim(label)), F.lit("_"), F.lit("-"))
    known = F.create_map(*(F.lit(x) for pair in CODES.items() for x in pair))
    return F.coalesce(F.try_element_at(known, text), F.try_element_at(known, F.get(F.split(text, r"[-\s(]"), F.lit(0))))


# Kana, ideographs and compatibility ideographs, as ranges of a pattern.
_HAN = r"\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_KANA = r"\u3041-\u30ff"
_CJK = _KANA + _HAN
_BETWEEN = re.compile(rf"(?<=[{_CJK}、。，！？；：])\s+|\s+(?=[{_CJK}、。，！？；：])")
_SPACE = re.compile(r"\s+")
_ODD = re.compile("[­​-‏⁠﻿]")
_END = re.compile(rf"[.!?…]+[\"'”’»)\]]*(?=\s|$|[A-ZÀ-ÞА-Я¡¿{_CJK}])|[。！？]+[」』”’》）]*|\n+|(?<=[{_CJK}])(?=[A-ZÀ-Þ][^\W\d_]* [^{_CJK}。]{{24}})|(?<=[^\W\d_]{{2}})(?=[А-Я][а-яё]* [а-яё]+ )|(?<=[а-яё])(?=[A-ZÀ-Þ][^\W\d_]* [^а-яё]{{24}})")
_SCRIPTS = {"han": re.compile(f"[{_HAN}]"), "kana": re.compile(f"[{_KANA}]"), "cyrillic": re.compile(r"[\u0400-\u04ff]"), "latin": re.compile(r"[a-z\u00e0-\u024f]")}
_LATIN = frozenset({"latin"})
_WORD = re.compile(rf"[{_CJK}]|[^\W\d_{_CJK}]+")


def plain(text: str) -> str:
    """Width, case, invisible characters and spacing set aside."""
    if not text.isascii():
        text = _BETWEEN.sub("", _ODD.sub("", unicodedata.normalize("NFKC", text)))
    return _SPACE.sub(" ", text).strip().casefold()


def words_at_least(text: str, n: int) -> bool:
    return sum(1 for _ in islice(_WORD.finditer(text), n)) == n


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """(begin, end) of the sentences and lines of a text, which they cover."""
    begin = 0
    for m in _END.finditer(text):
        if text[begin : m.end()].strip():
            yield begin, m.end()
            begin = m.end()
    if text[begin:].strip():
        yield begin, len(text)


def blocks(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """A segment without inner ends of sentences, in blocks that end between words."""
    while end - begin > LONG:
        cut = begin + BLOCK
        space = text.rfind(" ", begin + BLOCK // 2, cut)
        cut = space + 1 if space >= 0 else cut
        yield begin, cut
        begin = cut
    yield begin, end


def scripts(text: str) -> Counter[str]:
    """How many letters of a text stand in each script."""
    out: Counter[str] = Counter()
    for name, found in _SCRIPTS.items():
        n = len(found.findall(text))
        if n:
            out[name] = n
    return out


def main_scripts(text: str) -> tuple[str, frozenset[str]]:
    """(the script of most letters, all scripts) of a text."""
    if text.isascii():
        return ("latin", _LATIN) if _SCRIPTS["latin"].search(text) else ("", frozenset())
    have = [name for name, found in _SCRIPTS.items() if found.search(text)]
    main = have[0] if len(have) == 1 else max(have, key=lambda s: len(_SCRIPTS[s].findall(text))) if have else ""
    return main, frozenset(have)


@dataclass
class Classifier:
    """Raw-content dictionaries, and the compressors made of them in each worker.

    needs and lacks hold the scripts that nearly every, or hardly any, training text of a
    language has. A language that the scripts of a text rule out can't win, nor does the margin
    over it count. The label "" stands for no dictionary.
    """

    dictionaries: dict[str, bytes]
    least_bytes: int = LEAST_BYTES
    least_share: float = LEAST_SHARE
    needs: dict[str, frozenset[str]] = field(default_factory=dict)
    lacks: dict[str, frozenset[str]] = field(default_factory=dict)
    _made: list = field(default_factory=list, repr=False)
    _left: dict = field(default_factory=dict, repr=False)

    @classmethod
    def of(cls, texts: dict[str, list[str]]) -> Classifier:
        out = cls({label: packed(own) for label, own in sorted(texts.items()) if own})
        for label in out.dictionaries:
            own = texts[label]
            has = Counter(s for t in own for s in scripts(t))
            out.needs[label] = frozenset(s for s in _SCRIPTS if has[s] >= 0.98 * len(own))
            out.lacks[label] = frozenset(s for s in _SCRIPTS if has[s] <= 0.02 * len(own))
        return out

    def __getstate__(self):
        return self.dictionaries, self.least_bytes, self.least_share, self.needs, self.lacks

    def __setstate__(self, state):
        self.dictionaries, self.least_bytes, self.least_share, self.needs, self.lacks = state
        self._made, self._left = [], {}

    def _compressors(self, closer: bool) -> dict:
        if not self._made:
            import zstandard

            for level in LEVELS:
                own = {}
                for label, content in sorted(self.dictionaries.items()):
                    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                    d.precompute_compress(level=level)
                    own[label] = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress
                own[""] = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False).compress
                self._made.append(own)
        return self._made[closer]

    def sizes(self, data: bytes, labels: tuple[str, ...] | None = None, closer: bool = False) -> list[tuple[int, str]]:
        """Compressed bytes for each language, smallest first."""
        own = self._compressors(closer)
        return sorted([(len(own[label](data)), label) for label in labels or self.dictionaries])

    def possible(self, text: str) -> tuple[str, ...]:
        """The languages that the scripts of a text leave."""
        if not self.needs:
            return tuple(self.dictionaries)
        have = main_scripts(text)
        left = self._left.get(have)
        if left is None:
            main, every = have
            ok = [c for c in sorted(self.dictionaries) if main and main not in self.lacks[c] and self.needs[c] <= every]
            left = self._left[have] = tuple(ok or sorted(self.dictionaries))
        return left

    def classify(self, text: str) -> tuple[str | None, float]:
        """(language, confidence from 0 to 1) of a plain text; no language if the margin is narrow."""
        if not text or not self.dictionaries:
            return None, 0.0
        left = self.possible(text)
        if len(left) == 1:
            left = (*left, "")
        data = text.encode("utf-8", "surrogatepass")
        confidence = 0.0
        for closer in (False, True):
            best, second = self.sizes(data, left, closer)[:2]
            margin = second[0] - best[0]
            confidence = min(1.0, margin / max(1, second[0]))
            if margin >= max(self.least_bytes, self.least_share * len(data)):
                return best[1] or None, confidence
        return None, confidence

    def nearest(self, text: str) -> str | None:
        """The one language that makes a text smallest, however narrow the margin."""
        ranked = self.sizes(text.encode("utf-8", "surrogatepass"), self.possible(text), True)
        return ranked[0][1] if ranked and (len(ranked) == 1 or ranked[0][0] < ranked[1][0]) else None


def agreeing(labelled: Iterable[tuple[str, str]], words) -> dict[str, list[str]]:
    """The texts of (label, text) whose words, by their counts over the whole sample, fit the label best."""
    rows = [(label, text, words(text)) for label, text in labelled]
    counts: dict[str, Counter[str]] = defaultdict(Counter)
    total: Counter[str] = Counter()
    for label, _, own in rows:
        counts[label].update(own)
        total.update(own)
    known = {w for w, n in total.items() if n >= 3}
    size = {label: sum(n for w, n in c.items() if w in known) + 0.5 * len(known) for label, c in counts.items()}
    logs = {label: {w: math.log((c[w] + 0.5) / size[label]) for w in known} for label, c in counts.items()}
    out: dict[str, list[str]] = {label: [] for label in counts}
    for label, text, own in rows:
        own = [w for w in own if w in known]
        fit = {c: sum(logs[c][w] for w in own) for c in logs}
        if own and all(fit[label] >= f + AGREE for c, f in fit.items() if c != label):
            out[label].append(text)
    return out


def packed(texts: Iterable[str], most: int = DICT_BYTES) -> bytes:
    """Different texts in the order of their hashes, as far as they fit."""
    out, size = [], 0
    for t in sorted(set(texts), key=lambda t: hashlib.md5(t.encode("utf-8", "surrogatepass")).digest()):
        b = t.encode("utf-8", "surrogatepass") + b"\n"
        if size + len(b) > most:
            break
        out.append(b)
        size += len(b)
    return b"".join(out)


def sample(rows: DataFrame, per_label: int = SAMPLE_ROWS) -> DataFrame:
    """About per_label rows of each label of (label, row_id, text), by the hash of row_id; the labels must be few."""
    counts = rows.where("label is not null").groupBy("label").count().collect()
    if not counts:
        return rows.limit(0)
    shares = F.create_map(*(x for r in counts for x in (F.lit(r["label"]), F.lit(per_label / r["count"]))))
    place = F.pmod(F.xxhash64("row_id"), F.lit(1 << 40)) / float(1 << 40)
    return rows.where(place < F.try_element_at(shares, F.col("label")))


def fit_languages(documents: DataFrame, sides: list[tuple[DataFrame, str, str]]) -> Classifier:
    """Fits on at most about SAMPLE_ROWS labelled documents for each notation's language, with at
    most SAMPLE_SENTENCES of each, and on as many texts of each of sides (table, column, language)."""
    rows = sample(documents.select(label_code(F.col("lang")).alias("label"), F.col("doc_id").alias("row_id"), "text").where("lang is not null and text is not null"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, texts = [], []
            for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                code = code_of(label)
                if code:
                    own = {plain(text[a:e]) for a, e in sentences(text)}
                    for s in sorted(own, key=lambda s: hashlib.md5(s.encode("utf-8", "surrogatepass")).digest())[:SAMPLE_SENTENCES]:
                        n = scripts(s)
                        if words_at_least(s, LEAST_WORDS) and len(s) <= LONG and min(n["latin"] + n["cyrillic"], n["han"] + n["kana"]) <= 0.3 * n.total():
                            labels.append(code)
                            texts.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(texts, pa.string())], names=["label", "text"])

    labelled = [(r.label, r.text) for r in rows.mapInArrow(cut, "label string, text string").collect()]
    for df, column, code in sides:
        texts = sample(df.select(F.lit(code).alias("label"), F.col("id").alias("row_id"), F.col(column).alias("text")).where(F.col(column).isNotNull()))
        labelled += [(code, plain(r.text)) for r in texts.select("text").collect()]
    return Classifier.of(agreeing(labelled, _WORD.findall))


def segments(text: str, model: Classifier) -> list[tuple[int, int, str | None, float]]:
    """(begin, end, language, confidence) of the sentences of a text; long ones that hold several
    languages without ends of sentences between them come out in blocks."""
    out = []
    for begin, end in sentences(text):
        s = plain(text[begin:end])
        if not words_at_least(s, LEAST_WORDS):
            out.append((begin, end, None, 0.0))
            continue
        lang, sure = model.classify(s)
        if end - begin > LONG:
            parts = []
            for a, b in blocks(text, begin, end):
                p = plain(text[a:b])
                parts.append((a, b, *(model.classify(p) if words_at_least(p, 2 * LEAST_WORDS) else (None, 0.0))))
            told = [x for x in parts if x[2]]
            if len({x[2] for x in told}) > 1:
                out += parts
                continue
            mean = sum(x[3] for x in told) / max(1, len(told))
            if lang is None and mean >= CLEAR and 2 * sum(x[1] - x[0] for x in told) >= end - begin:  # a long text helps itself more than a dictionary does
                lang, sure = told[0][2], mean
        out.append((begin, end, lang, sure))
    return out


def document_segments(documents: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, segment, begin, end, lang, confidence): each sentence with its language, null where
    the margin is narrow. Null texts give no row."""
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            source, rows = [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                for k, s in enumerate(segments(text, model)):
                    source.append(i)
                    rows.append((k, *s))
            k, a, e, lang, sure = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(source, pa.int64())), pa.array(k, pa.int32()), pa.array(a, pa.int32()), pa.array(e, pa.int32()), pa.array(lang, pa.string()), pa.array(sure, pa.float64())],
                names=["doc_id", "segment", "begin", "end", "lang", "confidence"],
            )

    return documents.select("doc_id", "text").where("text is not null").mapInArrow(run, f"doc_id {kind}, segment int, begin int, end int, lang string, confidence double")


def odd_documents(documents: DataFrame, model: Classifier) -> DataFrame:
    """(id, lang) of documents that are mixed, or whose label is missing or names another language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, langs = [], []
            for i, label, text in zip(b.column("id").to_pylist(), b.column("lang").to_pylist(), b.column("text").to_pylist()):
                found = sorted({s[2] for s in segments(text, model) if s[2]})
                if not found:
                    whole, _ = model.classify(plain(text))
                    found = [whole] if whole else []
                if len(found) > 1 or found and code_of(label) != found[0]:
                    ids += [i] * len(found)
                    langs += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(langs, pa.string())], names=["id", "lang"])

    rows = documents.select(F.col("doc_id").cast("string").alias("id"), "lang", "text").where("text is not null and doc_id is not null")
    return rows.mapInArrow(run, "id string, lang string")


def odd_sides(pairs: DataFrame, model: Classifier, expected: dict[str, str]) -> DataFrame:
    """(tbl, id, lang) of texts in columns of pairs that aren't in the language expected there.

    A text with a narrow margin is taken to be in the expected language unless its script rules
    that out; then the nearest counts.
    """
    columns = list(expected)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tables, ids, langs = [], [], []
            own = b.column("id").to_pylist()
            for c in columns:
                for i, text in zip(own, b.column(c).to_pylist()):
                    if not text:
                        continue
                    text = plain(text)
                    lang, _ = model.classify(text)
                    if lang is None and expected[c] not in model.possible(text):
                        lang = model.nearest(text)
                    if lang and lang != expected[c]:
                        tables.append(f"pair.{c}")
                        ids.append(i)
                        langs.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(tables, pa.string()), pa.array(ids, pa.string()), pa.array(langs, pa.string())], names=["tbl", "id", "lang"])

    return pairs.select(F.col("id").cast("string").alias("id"), *columns).where("id is not null").mapInArrow(run, "tbl string, id string, lang string")


# Names of the catalog: the same classifier over classes of languages.

_NAME_PART = re.compile(rf"[{_CJK}]+|[^\W\d_{_CJK}]+|[^\w\s]")


def name_words(name: str) -> list[str]:
    """The words of a name; of ideographs each two neighbours."""
    out = []
    for part in _NAME_PART.findall(name):
        out += [part[k : k + 2] for k in range(len(part) - 1)] if re.match(f"[{_CJK}]", part) else [part]
    return out


@dataclass
class NameModel:
    """Reads a name as its overlapping triples of words that tell a class, others as one blank."""

    model: Classifier
    common: frozenset[str]
    idle: frozenset[str] = frozenset()

    def words(self, name: str) -> list[str]:
        out = ["‹"]
        for part in _NAME_PART.findall(plain(name)):
            if re.match(f"[{_CJK}]", part):
                keep = [False] * len(part)
                for k in range(len(part) - 1):
                    if part[k : k + 2] in self.common:
                        keep[k] = keep[k + 1] = True
                own = [c if k else "□" for c, k in zip(part, keep)]
            else:
                own = [part if part in self.common else "□"]
            for w in own:
                if w not in self.idle and not (w == "□" and out[-1] == "□"):
                    out.append(w)
        return [*out, "›"]

    def read(self, name: str) -> str:
        w = self.words(name)
        return "|".join("·".join(w[k : k + 3]) for k in range(max(1, len(w) - 2)))

    def classify(self, name: str) -> str | None:
        return self.model.classify(self.read(name))[0]


def known_class(label: Column) -> Column:
    return label.isin(*NAME_CLASSES)


def fit_names(snapshots: DataFrame) -> NameModel:
    """Fits on at most about SAMPLE_ROWS names for each class.

    Words are common from one name in two hundred on, pairs of ideographs from one in fifty on;
    words that stand in few names of any class, or as often in names of every class, tell nothing
    and are left out. What is left of a name goes into the dictionary of the class that most names
    with the same rest are labelled with.
    """
    rows = snapshots.select(F.col("lang").alias("label"), F.col("id").alias("row_id"), F.col("name").alias("text")).where(known_class(F.col("lang")) & F.col("name").isNotNull())
    pairs = [(label, name) for label, _, name in sorted({(r.label, r.row_id, r.text) for r in sample(rows.distinct()).collect()})]
    seen = Counter(w for _, t in pairs for w in set(name_words(plain(t))))
    common = frozenset(w for w, n in seen.items() if n >= max(3, len(pairs) / (50 if re.match(f"[{_CJK}]", w) else 200)))
    names = NameModel(Classifier({}, 1, 0.0), common)

    labels = Counter(label for label, _ in pairs)
    rate = Counter((label, w) for label, t in pairs for w in set(names.words(t)))
    rates = {w: [rate[label, w] / labels[label] for label in labels] for w in common}
    names.idle = frozenset(w for w, r in rates.items() if max(r) < 0.03 or len(r) > 1 and min(r) >= 0.3 * max(r))
    votes: dict[str, Counter[str]] = defaultdict(Counter)
    for label, t in pairs:
        votes[names.read(t)][label] += 1
    fit: dict[str, list[str]] = defaultdict(list)
    for form, own in votes.items():
        (label, n), *rest = own.most_common(2)
        if not rest or n > rest[0][1]:
            fit[label].append(form)
    names.model = Classifier({label: packed(forms) for label, forms in sorted(fit.items())}, 1, 0.0)
    return names


def odd_names(snapshots: DataFrame, names: NameModel) -> DataFrame:
    """(id, lang) of records whose class is missing, unknown or not the one their name tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, langs = [], []
            for i, label, name in zip(b.column("id").to_pylist(), b.column("lang").to_pylist(), b.column("name").to_pylist()):
                found = names.classify(name)
                if found and found != label:
                    ids.append(i)
                    langs.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(langs, pa.string())], names=["id", "lang"])

    rows = snapshots.select(F.col("id").cast("string").alias("id"), F.trim("lang").alias("lang"), "name").where("id is not null and name is not null").distinct()
    return rows.mapInArrow(run, "id string, lang string")


def found(documents: DataFrame, pairs: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(tbl, id, lang): every document, side and record whose language isn't what it should be.

    Null and empty texts, and texts whose margin is narrow, give no row; repeated rows count once.
    """
    model = fit_languages(documents, [(pairs, "en", "en"), (pairs, "zh", "zh")])
    names = fit_names(snapshots)
    return (
        odd_documents(documents, model).select(F.lit("documents").alias("tbl"), "id", "lang")
        .unionByName(odd_sides(pairs, model, {"en": "en", "zh": "zh"}))
        .unionByName(odd_names(snapshots, names).select(F.lit("record_snapshot").alias("tbl"), "id", "lang"))
        .distinct()
    )
