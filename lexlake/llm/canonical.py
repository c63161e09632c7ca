"""Problem 2: values typed freely, mapped to the items of a reference list.

Every printed form of an item, with all strings that arise from it by leaving out up to MAX_EDITS
characters, is a key of one dictionary that every task holds. A value is looked up under its own
such strings, so only forms within the edit bound are ever compared; the candidates are ranked by
weighted Damerau-Levenshtein distance, then by how often the item itself is printed. Values come
out as they stand in the rows, and a value that fills a third of all rows is looked up once for each
task. A reference list longer than BLOCK_ITEMS is taken in blocks, each a dictionary of its own; the
best of all blocks counts.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_EDITS = 2
MISS = -1
#: Forms are looked up by abbreviation from this many letters on.
LEAST_PREFIX = 3
#: Items whose dictionary a task holds at a time.
BLOCK_ITEMS = 10_000
#: Words that only weaken a label; another list is a parameter.
HEDGES = (
    "somewhat", "chiefly", "mainly", "mostly", "often", "usually", "especially", "esp", "now", "rather", "sometimes",
    "generally", "frequently", "occasionally", "partly", "largely", "slightly", "quite", "fairly", "typically",
    "commonly", "primarily", "mildly", "vaguely", "perhaps", "possibly", "also", "very", "a bit", "in part",
)
#: Keys next to each other on a keyboard.
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEAR = {frozenset((r[i], r[i + 1])) for r in ROWS for i in range(len(r) - 1)} | {
    frozenset((a, b)) for up, low in zip(ROWS, ROWS[1:]) for i, b in enumerate(low) for a in up[i : i + 2]
}


def folded(text: str) -> str:
    """Width, case, accents of spacing and outer punctuation set aside."""
    text = unicodedata.normalize("NFKC", text).casefold()
    return re.sub(r"\s+", " ", text).strip()


def compact(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


def allowed(length: int) -> int:
    """Edits that still tell forms of this length apart."""
    return 0 if length <= 3 else 1 if length <= 5 else MAX_EDITS


def deletions(word: str, most: int) -> set[str]:
    out = {word}
    for k in range(1, min(most, len(word)) + 1):
        out.update("".join(word[i] for i in keep) for keep in combinations(range(len(word)), len(word) - k))
    return out


def distance(a: str, b: str) -> tuple[int, float]:
    """(edits, weight) of the cheapest way from a to b by restricted Damerau-Levenshtein.

    Neighbouring keys, doubled or dropped double letters and transpositions weigh less.
    """

    def change(x: str, y: str) -> float:
        return 0.0 if x == y else 0.7 if frozenset((x, y)) in _NEAR else 1.0

    def gap(s: str, i: int) -> float:
        return 0.6 if (i and s[i] == s[i - 1]) or (i + 1 < len(s) and s[i] == s[i + 1]) else 0.9

    rows = [[(j, sum(gap(b, k) for k in range(j))) for j in range(len(b) + 1)]]
    for i, x in enumerate(a):
        row = [(i + 1, rows[i][0][1] + gap(a, i))]
        for j, y in enumerate(b):
            c = change(x, y)
            d, w = rows[i][j]
            best = (d + (x != y), w + c)
            d, w = rows[i][j + 1]
            best = min(best, (d + 1, w + gap(a, i)))
            d, w = row[j]
            best = min(best, (d + 1, w + gap(b, j)))
            if i and j and x == b[j - 1] and a[i - 1] == y and x != y:
                d, w = rows[i - 1][j - 1]
                best = min(best, (d + 1, w + 0.8))
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


#: How well an item fits, the smaller the better: (kind of finding, weight, frequency with a minus, item).
Rank = tuple[int, float, int, int]
NEAR, SHORT, SHORT_ALIAS, FAR, NONE = range(5)


@dataclass
class Dictionary:
    """The symmetric-delete dictionary of one set of items."""

    exact: dict[str, set[int]] = field(default_factory=dict)
    deletes: dict[str, set[tuple[str, int]]] = field(default_factory=dict)
    forms: list[tuple[str, int, bool]] = field(default_factory=list)
    frequency: dict[int, int] = field(default_factory=dict)
    hedges: tuple[str, ...] = HEDGES
    known: dict[str, Rank] = field(default_factory=dict)
    _sorted: list[tuple[str, int, bool]] | None = None

    def add(self, item: int, form: str, main: bool) -> None:
        key = compact(folded(form))
        if not key:
            return
        self.exact.setdefault(key, set()).add(item)
        self.forms.append((key, item, main))
        for d in deletions(key, allowed(len(key) + 1)):
            self.deletes.setdefault(d, set()).add((key, item))

    def _often(self, items: set[int]) -> tuple[int, int]:
        return min((-self.frequency.get(i, 0), i) for i in items)

    def _near(self, key: str) -> Rank | None:
        """The best form within the edit bound."""
        if key in self.exact:
            return NEAR, 0.0, *self._often(self.exact[key])
        seen: set[tuple[str, int]] = set()
        for d in deletions(key, allowed(len(key) + 1)):
            seen |= self.deletes.get(d, set())
        ranked = []
        for form, item in seen:
            edits, weight = distance(key, form)
            if edits <= min(allowed(max(len(key), len(form))), allowed(len(form) + 1)):
                ranked.append((edits, weight, -self.frequency.get(item, 0), item))
        if not ranked:
            return None
        edits, weight, often, item = min(ranked)
        return NEAR if edits < 1 else FAR, edits + weight / 100, often, item

    def _short(self, text: str) -> Rank | None:
        """The item of which text, with its full stop, is an abbreviation."""
        key = compact(text)
        if not text.endswith(".") or len(key) < LEAST_PREFIX:
            return None
        if self._sorted is None:
            self._sorted = sorted(set(self.forms))
        a, b = bisect_left(self._sorted, (key,)), bisect_left(self._sorted, (key + chr(0x10FFFF),))
        own = [(form, item, main) for form, item, main in self._sorted[a:b] if len(form) > len(key)]
        for kind, main in ((SHORT, True), (SHORT_ALIAS, False)):
            if items := {item for _, item, m in own if m == main}:
                return kind, 0.0, *self._often(items)
        return None

    def find(self, value: str) -> Rank:
        """The item that value means, with how well it fits; MISS if it means none."""
        hit = self.known.get(value)
        if hit is None:
            if len(self.known) > 200_000:
                self.known.clear()
            hit = self.known[value] = self._find(value)
        return hit

    def _find(self, value: str) -> Rank:
        text = folded(value).strip(" ()[]<>{}\"'“”‘’«»,:;、，：；")
        tries = [text]
        bare = text
        while True:  # several weakening words may stand before a label
            word = next((h for h in self.hedges if bare.startswith(h) and re.match(r"[\s.]+\S", bare[len(h) :])), None)
            if word is None:
                break
            bare = bare[len(word) :].lstrip(" .").strip(" ()[]<>,:;")
            tries.append(bare)
        found = [near for t in tries if (key := compact(t)) and (near := self._near(key))]
        short = next((hit for t in tries if (hit := self._short(t))), None)
        near = min(found, key=lambda r: r[1:], default=None)
        return min((r for r in (near, short) if r), default=(NONE, 0.0, 0, MISS))


def reference(items: DataFrame, size: int = BLOCK_ITEMS) -> Iterator[list[tuple[int, str, str, list[str]]]]:
    """The reference list in blocks of size items."""
    block: list[tuple[int, str, str, list[str]]] = []
    for r in items.select("item_id", "axis", "value", "aliases").where("item_id is not null").toLocalIterator():
        block.append((r.item_id, r.axis or "", r.value or "", [a for a in r.aliases or [] if a]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def dictionaries(items: list[tuple[int, str, str, list[str]]], frequency: Counter[int], hedges: tuple[str, ...] = HEDGES) -> dict[str, Dictionary]:
    """A dictionary for each axis, and one ("*") for all axes but pos."""
    out: dict[str, Dictionary] = {"*": Dictionary(frequency=frequency, hedges=hedges), "pos": Dictionary(frequency=frequency, hedges=hedges)}
    for item, axis, value, aliases in items:
        for name in {axis, "*"} if axis != "pos" else {"pos"}:
            d = out.setdefault(name, Dictionary(frequency=frequency, hedges=hedges))
            d.add(item, value, True)
            for a in aliases:
                d.add(item, a, False)
    return out


def typed_values(s_sense: DataFrame, label: DataFrame) -> DataFrame:
    """(field, id, ord, scope, value): each value that isn't null or empty; scope names the dictionary."""
    marks = s_sense.select(F.col("id").cast("long").alias("id"), F.posexplode("labels").alias("ord", "value"))
    return (
        marks.select(F.lit("s_sense.labels").alias("field"), "id", F.col("ord").cast("long").alias("ord"), F.lit("*").alias("scope"), "value")
        .unionAll(s_sense.select(F.lit("s_sense.pos"), F.col("id").cast("long"), F.lit(0).cast("long"), F.lit("pos"), "pos"))
        .unionAll(label.select(F.lit("label.value"), F.col("id").cast("long"), F.lit(0).cast("long"), F.coalesce("axis", F.lit("")), "value"))
        .where("value is not null and value <> '' and id is not null")
    )


def mapped(values: DataFrame, items: DataFrame, hedges: tuple[str, ...] = HEDGES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(field, id, ord, item_id) of rows (field, id, ord, scope, value); MISS where none is meant.

    Values that are an item's own value character for character are left out: nothing is to be
    mapped there. They give the reference frequencies, counted over all rows. A value delivered
    again counts once; should its deliveries differ, the largest item counts. White space or
    punctuation alone, and values of an axis that the list doesn't have, are misses. hedges are
    the words that only weaken a label.
    """
    own = items.where("item_id is not null and value is not null").groupBy("value").agg(F.max("item_id").alias("item"))
    counts = values.groupBy("value").count().join(own, "value").groupBy("item").agg(F.sum("count").alias("n")).collect()  # one row for each item at most
    frequency = Counter({r["item"]: r["n"] for r in counts})
    typed = values.join(own.select("value"), "value", "left_anti").select("field", "id", "ord", "scope", "value")

    def against(block: list[tuple[int, str, str, list[str]]]) -> DataFrame:
        found = dictionaries(block, frequency, hedges)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none = Dictionary()
            for b in batches:
                scopes, texts = b.column("scope").to_pylist(), b.column("value").to_pylist()
                kind, weight, often, item = zip(*(found.get(s, none).find(v) for s, v in zip(scopes, texts))) if texts else ((),) * 4
                rank = pa.StructArray.from_arrays([pa.array(kind, pa.int32()), pa.array(weight, pa.float64()), pa.array(often, pa.int64()), pa.array(item, pa.int64())], names=["kind", "weight", "often", "item"])
                yield pa.RecordBatch.from_arrays([b.column("field"), b.column("id"), b.column("ord"), b.column("value"), rank], names=["field", "id", "ord", "value", "rank"])

        return typed.mapInArrow(run, "field string, id long, ord long, value string, rank struct<kind: int, weight: double, often: long, item: long>")

    blocks = list(map(against, reference(items, block_items))) or [against([])]
    rows = blocks[0]
    if len(blocks) > 1:
        rows = reduce(DataFrame.unionAll, blocks).groupBy("field", "id", "ord", "value").agg(F.min("rank").alias("rank"))
    return rows.groupBy("field", "id", "ord").agg(F.max("rank.item").alias("item_id"))
