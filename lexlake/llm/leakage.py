"""Problem 7: passages of evaluation items inside a training corpus.

Texts are brought into one form and read as words, in Chinese and Japanese as characters. Seeds
are all n-grams of the items, common ones too: an item that leaked widely makes its own seeds
common. Where a document holds a seed of an item, the two are aligned by Smith-Waterman in the
band of diagonals around the seed, again and again over what is left of the item, so that a
passage in several runs, in another order or with changed words is found as a whole. An item has
leaked if the runs hold enough of its text. An item too short for a seed is its own seed: it has
leaked where it stands as a whole.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.codes import BASES, TABLE, CodeMap, chunks, flatten, mix, segment_hash
from lexlake.llm.lookalike import one_form_codes

#: Length of a seed in words, and in characters where these are read one by one.
WORDS, CHARS = 5, 8
#: Scores of the alignment. A run counts from the score of one seed on, however long the document.
MATCH, MISMATCH, GAP = 2, -2, -2
#: Bands of diagonals: they begin at multiples of STEP, with HALF more on either side.
STEP, HALF = 8, 4
WIDTH = STEP + 2 * HALF
#: Words of a document within which runs stand together.
STRETCH = 256
#: Part of an item's text that the runs must hold.
HELD = 0.5
#: Items are handled in blocks of about this many characters, which every task holds; each block is one
#: scan of the documents.
BLOCK_CHARS = 20_000_000
#: Cells of the tables of alignments that are computed side by side; what is beyond it comes in the next block.
CELLS = 2_000_000


@lru_cache(maxsize=1)
def _kinds() -> tuple[CodeMap, np.ndarray]:
    """Case folding, and the kind of each character: 0 between words, 1 in words, 2 a word of its own."""

    def kind(c: int) -> int:
        if 0x2E80 <= c < 0xA000 and not 0x3000 <= c < 0x3041 or 0xF900 <= c < 0xFB00:
            return 2
        return int(unicodedata.category(chr(c))[0] in "LNM")

    kinds = np.zeros(TABLE, np.uint8)
    kinds[:0x20000] = [kind(c) for c in range(0x20000)]
    kinds[0x20000:0x40000] = 2  # ideographs
    return CodeMap(lambda c: chr(c).casefold()), kinds


@dataclass
class Words:
    """The words of a batch: hash, whether a single character, and where each row begins."""

    hash: np.ndarray
    single: np.ndarray
    starts: np.ndarray

    def grams(self, n: int, single: bool) -> np.ndarray:
        """Hash of the n words from each single character, or from each other word, on; 0 where none fits."""
        end = np.repeat(self.starts[1:], np.diff(self.starts))
        fits = np.flatnonzero((self.single == single) & (np.arange(len(self.hash)) + n <= end))
        total = np.zeros(len(fits), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                total = total * np.uint64(BASES[0]) + mix(self.hash[fits + k], 1)
        out = np.zeros(len(self.hash), np.uint64)
        out[fits] = mix(total, n) | np.uint64(1)
        return out


def words(col: pa.Array) -> Words:
    fold, kinds = _kinds()
    codes, starts = fold.apply(*one_form_codes(*flatten(col)))
    kind = kinds[codes]
    begins = kind == 2
    inner = kind == 1
    before = np.zeros(len(codes), bool)
    before[1:] = inner[:-1]
    before[starts[:-1][starts[:-1] < len(codes)]] = False
    begins |= inner & ~before
    kept = np.flatnonzero(kind > 0)
    first = np.flatnonzero(begins[kept])
    h = segment_hash(codes[kept], np.append(first, len(kept)), 0)
    single = kind[kept[first]] == 2
    place = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(begins, out=place[1:])
    return Words(h, single, place[starts])


#: The seeds of items that are long enough for them: (words, single characters).
USUAL = ((WORDS, False), (CHARS, True))


@dataclass
class Items:
    """A block of items as their words, and their seeds of each length in order of hash."""

    ids: list[int]
    words: list[np.ndarray]
    single: np.ndarray  # whether most words of an item are single characters
    size: np.ndarray
    seeds: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray, np.ndarray]]  # (hash, item, place)

    def coded(self, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """(the different words of all items, each item's words as numbers of these, padded with -2)."""
        vocabulary = np.unique(np.concatenate(self.words))
        own = np.full((len(self.words), longest), -2, np.int32)
        for k, x in enumerate(self.words):
            own[k, : len(x)] = np.searchsorted(vocabulary, x)
        return vocabulary, own


def item_block(rows: list[tuple[int, str]]) -> Items:
    w = words(pa.array([t for _, t in rows], pa.string()))
    size = np.diff(w.starts)
    owner = np.repeat(np.arange(len(rows)), size)
    at = np.arange(len(w.hash)) - np.repeat(w.starts[:-1], size)
    seeds = {}
    without = size > 0
    for n, single in USUAL:
        gram = w.grams(n, single)
        without[owner[gram > 0]] = False
        seeds[n, single] = gram, gram > 0
    for i in np.flatnonzero(without):
        kind = int(size[i]), bool(w.single[w.starts[i]])
        gram, use = seeds.setdefault(kind, (w.grams(*kind), np.zeros(len(w.hash), bool)))
        use[w.starts[i]] = True
    packed = {}
    for kind, (gram, use) in seeds.items():
        order = np.argsort(gram, kind="stable")
        order = order[use[order]]
        if len(order):
            packed[kind] = gram[order], owner[order], at[order]
    mean = np.add.reduceat(np.append(w.single, 0), w.starts[:-1]) / np.maximum(size, 1) if len(rows) else np.zeros(0)
    return Items([i for i, _ in rows], [w.hash[a:b] for a, b in zip(w.starts, w.starts[1:])], (mean > 0.5) & (size > 0), size, packed)


def hits(w: Words, items: Items) -> tuple[np.ndarray, ...]:
    """(row, item, place in all words, place in the item) of every seed of an item that stands in a row."""
    out = []
    for kind, (seed, owner, at_item) in items.seeds.items():
        gram = w.grams(*kind)
        begin, end = np.searchsorted(seed, gram), np.searchsorted(seed, gram, side="right")
        at = np.flatnonzero((end > begin) & (gram > 0))
        n = end[at] - begin[at]
        s = np.repeat(begin[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(at, n)
        out.append((np.searchsorted(w.starts, at, side="right") - 1, owner[s], at, at_item[s]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 4


def bands(w: Words, items: Items, row: np.ndarray, item: np.ndarray, at_doc: np.ndarray, at_item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, first diagonal) of the bands of diagonals that hold a seed, in order.

    A diagonal is the place in the document less the place in the item. Bands begin at multiples
    of STEP less HALF and are WIDTH wide, so every seed has HALF diagonals on either side.
    """
    step = np.floor_divide(at_doc - w.starts[row] - at_item, STEP)
    order = np.lexsort((step, item, row))
    row, item, step = row[order], item[order], step[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (step[1:] != step[:-1])
    return row[new], item[new], step[new] * STEP - HALF


def equal_words(doc: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For bands (begin and end of the row in doc, first diagonal, item's words padded with -2) whether the
    word of the item equals that of the document: (band, place in the item, diagonal)."""
    at = (begin + first)[:, None] + np.arange(own.shape[1] + WIDTH - 1)
    inside = (at >= begin[:, None]) & (at < end[:, None])
    near = np.where(inside, doc[np.where(inside, at, 0)], np.int32(-1))
    return np.lib.stride_tricks.sliding_window_view(near, WIDTH, axis=1) == own[:, :, None]


def forward(same: np.ndarray) -> np.ndarray:
    """Scores of Smith-Waterman within the bands, all bands side by side: (place in the item, band, diagonal)."""
    n = same.shape[1]
    ramp = np.arange(WIDTH, dtype=np.int32) * -GAP
    score = np.zeros((n + 1, len(same), WIDTH), np.int32)
    for j in range(n):
        row = score[j] + np.where(same[:, j], np.int32(MATCH), np.int32(MISMATCH))
        np.maximum(row[:, :-1], score[j][:, 1:] + GAP, out=row[:, :-1])  # a word of the item is missing
        np.maximum(row, 0, out=row)
        row += ramp
        np.maximum.accumulate(row, axis=1, out=row)  # words of the document are too many
        np.subtract(row, ramp, out=score[j + 1])
    return score[1:]


def reachable(same: np.ndarray, least: np.ndarray) -> np.ndarray:
    """(band, place in the item): which words match in some alignment of their band that scores least.

    A match lies in an alignment that scores what both ends bring to it; held never has a word
    that isn't reachable.
    """
    both = forward(same) + forward(same[:, ::-1, ::-1])[::-1, :, ::-1]
    return ((both >= (least + MATCH)[None, :, None]) & same.transpose(1, 0, 2)).any(axis=2).T


@dataclass
class Run:
    """A local alignment: its score, the diagonal and place of its last word, and the words of the item that it holds."""

    score: int
    at: int
    holds: np.ndarray


def runs(same: np.ndarray, least: int) -> Iterator[Run]:
    """The local alignments in one band, each the best by Smith-Waterman over the words of the item that
    are still free, until none scores least."""
    n = len(same)
    free = np.ones(n, bool)
    ramp = np.arange(WIDTH) * -GAP
    while True:
        score = np.zeros((n + 1, WIDTH), np.int64)
        for j in range(n):
            if free[j]:
                row = np.maximum(0, score[j] + np.where(same[j], MATCH, MISMATCH))
                row[:-1] = np.maximum(row[:-1], score[j][1:] + GAP)
                score[j + 1] = np.maximum.accumulate(row + ramp) - ramp
        j, d = np.unravel_index(int(score.argmax()), score.shape)
        if score[j, d] < least:
            return
        run = Run(int(score[j, d]), int(j + d), np.zeros(n, bool))
        while j > 0 and score[j, d] > 0:
            free[j - 1] = False
            if score[j, d] == score[j - 1, d] + (MATCH if same[j - 1, d] else MISMATCH):
                run.holds[j - 1] |= same[j - 1, d]
                j -= 1
            elif d + 1 < WIDTH and score[j, d] == score[j - 1, d + 1] + GAP:
                j, d = j - 1, d + 1
            else:
                free[j - 1] = True
                d -= 1
        yield run


def share_of(found: list[Run], n: int, length: int, least: int) -> float:
    """The part of an item of n words that runs in a document of length words hold.

    Runs that stand together, within STRETCH words or four times the item, count from least on.
    Over a whole document chance finds more the longer it is: runs that stand apart count if they
    score MATCH more for each doubling of the document beyond STRETCH. So a copy in one place is
    found in a document of any length, and phrases that stand here and there add up to none.
    """
    stretch = max(STRETCH, 4 * n)
    apart = least + MATCH * math.log2(max(1.0, length / STRETCH))
    strong = [r.holds for r in found if r.score >= apart]
    best = int(np.logical_or.reduce(strong).sum()) if strong else 0
    found = sorted(found, key=lambda r: r.at)
    end = 0
    for k, r in enumerate(found):
        if end < len(found):  # else this stretch is part of the one before
            end = next((e for e in range(max(end, k), len(found)) if found[e].at >= r.at + stretch), len(found))
            best = max(best, int(np.logical_or.reduce([x.holds for x in found[k:end]]).sum()))
    return best / n


def held_shares(w: Words, items: Items, row: np.ndarray, item: np.ndarray, first: np.ndarray, wanted: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, held) of the pairs among the bands (row, item, first) of which at least wanted is held.

    Two upper bounds come before the full alignment, each over all bands of a pair: words that match
    in a band at all, and words that are reachable.
    """
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    pair = np.cumsum(new) - 1
    size = items.size[item]
    longest = int(items.size.max())
    vocabulary, own = items.coded(longest)
    at = np.minimum(np.searchsorted(vocabulary, w.hash), len(vocabulary) - 1)
    doc = np.append(np.where(vocabulary[at] == w.hash, at, -1), -1).astype(np.int32)
    # One seed is enough for a run; an item without seeds must stand as a whole.
    least = np.minimum(np.where(items.single, MATCH * CHARS, MATCH * WORDS), MATCH * items.size)[item]

    def over(which: np.ndarray, f) -> np.ndarray:
        """The bands of which whose pairs f leaves enough words; f gets them in blocks of bounded size."""
        enough = np.zeros(int(pair[-1]) + 1, bool)
        before, mask = -1, np.zeros(longest, bool)  # a pair that goes on in the next block
        total = np.cumsum(size[which] * WIDTH)
        begin = 0
        while begin < len(which):
            part = which[begin : max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + CELLS, side="right")))]
            n = int(size[part].max())
            got = f(equal_words(doc, w.starts[row[part]], w.starts[row[part] + 1], first[part], own[item[part], :n]), part)
            at = np.flatnonzero(np.r_[True, np.diff(pair[part]) > 0])
            union = np.logical_or.reduceat(got, at, axis=0)
            if pair[part[0]] == before:
                union[0] |= mask[:n]
            before, mask = pair[part[-1]], np.append(union[-1], np.zeros(longest - n, bool))
            enough[pair[part[at]]] |= union.sum(axis=1) >= wanted * size[part[at]]
            begin += len(part)
        return which[enough[pair[which]]]

    left = over(np.arange(len(row)), lambda same, part: same.any(axis=2))
    left = over(left, lambda same, part: reachable(same, least[part])) if len(left) else left
    out: list[tuple[int, int, float]] = []
    for mine in np.split(left, np.flatnonzero(np.diff(pair[left])) + 1) if len(left) else []:
        r, i = int(row[mine[0]]), int(item[mine[0]])
        n, a, b = int(size[mine[0]]), w.starts[r], w.starts[r + 1]
        found: list[Run] = []
        for k in mine.tolist():
            same = equal_words(doc, np.array([a]), np.array([b]), first[k : k + 1], own[i : i + 1, :n])[0]
            found += [Run(x.score, x.at + int(first[k]), x.holds) for x in runs(same, int(least[k]))]
        share = share_of(found, n, int(b - a), int(least[mine[0]]))
        if share >= wanted:
            out.append((r, i, share))
    rows, items_, shares = zip(*out) if out else ((),) * 3
    return np.array(rows, np.int64), np.array(items_, np.int64), np.array(shares, float)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", held: float = HELD) -> DataFrame:
    """(doc_id, item_id, held): documents that hold at least held of an item's text, and how much.

    Null and empty texts on either side leak nothing; repeated documents and items count once. The
    items come to the driver in blocks of BLOCK_CHARS, each block is held against all documents.
    """
    kind = dict(docs.dtypes)[doc_id]
    listed = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").distinct()
    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).where("d is not null and t is not null")

    def against(block: list[tuple[int, str]]) -> DataFrame:
        kept = item_block(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, "t"):
                    w = words(part.column("t"))
                    row, item, at_doc, at_item = hits(w, kept)
                    share = np.empty(0)
                    if len(row):
                        row, item, share = held_shares(w, kept, *bands(w, kept, row, item, at_doc, at_item), held)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("d").take(pa.array(row, pa.int64())), pa.array([kept.ids[i] for i in item], pa.int64()), pa.array(share, pa.float64())], names=["doc_id", "item_id", "held"]
                    )

        return rows.mapInArrow(run, f"doc_id {kind}, item_id long, held double")

    out, block, size = None, [], 0
    for r in listed.toLocalIterator():
        block.append((r.i, r.t))
        size += len(r.t)
        if size >= BLOCK_CHARS:
            out, block, size = against(block) if out is None else out.unionAll(against(block)), [], 0
    if block or out is None:
        out = against(block) if out is None else out.unionAll(against(block))
    return out.groupBy("doc_id", "item_id").agg(F.max("held").alias("held"))
