"""Problem 6: one form for texts that look the same but differ in characters.

A text is taken apart into positioned code points (rows of a flat array), each is joined to its
decomposition and its look-alike (lookup tables that every task holds), combining marks are
ordered by class within their base, bases and marks are put together again, and the strings are
rebuilt. All of it works on whole Arrow batches, so that no row is exploded across a shuffle.

What counts as looking the same: width, canonical equivalents, ligatures, CJK compatibility
forms and radicals, invisible characters, kinds of space and of hyphen, and letters of other
scripts with the shape of a Latin one. Case, accents, superscripts, circled forms, simplified
against traditional characters stay different.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.codes import MAPPED, TABLE, CodeMap, chunks, flatten, strings

# Letters of other scripts that have the shape of a Latin letter.
SAME_SHAPE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v", "ո": "n", "ս": "u",
    "օ": "o", "ց": "g", "հ": "h", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H",
    "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Һ": "H", "Ӏ": "I", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z",
    "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y",
    "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "ρ": "p", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "α": "a", "υ": "u",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꮖ": "I", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L",
    "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "‐": "-", "‑": "-", "⁃": "-", "ǃ": "!", "ː": ":", "։": ":",
}

# Radicals of the supplement and the ideographs they look like.
RADICALS = {
    "⺁": "厂", "⺂": "乛", "⺃": "乚", "⺄": "乙", "⺅": "亻", "⺆": "冂", "⺈": "刀", "⺉": "刂", "⺊": "卜",
    "⺋": "㔾", "⺎": "兀", "⺏": "尣", "⺐": "尢", "⺒": "巳", "⺓": "幺", "⺔": "彑", "⺕": "彐", "⺖": "忄",
    "⺗": "㣺", "⺘": "扌", "⺙": "攵", "⺛": "旡", "⺜": "日", "⺝": "月", "⺞": "歺", "⺠": "民", "⺡": "氵",
    "⺢": "氺", "⺣": "灬", "⺤": "爫", "⺥": "爫", "⺦": "丬", "⺧": "牛", "⺨": "犭", "⺩": "王", "⺪": "疋",
    "⺫": "目", "⺬": "示", "⺭": "礻", "⺮": "竹", "⺯": "糹", "⺰": "纟", "⺱": "罓", "⺲": "罒", "⺶": "羊",
    "⺹": "耂", "⺺": "肀", "⺻": "聿", "⺼": "肉", "⺽": "臼", "⺾": "艹", "⺿": "艹", "⻀": "艹", "⻁": "虎",
    "⻂": "衤", "⻃": "覀", "⻄": "西", "⻅": "见", "⻆": "角", "⻈": "讠", "⻉": "贝", "⻊": "足", "⻋": "车",
    "⻌": "辶", "⻍": "辶", "⻎": "辶", "⻏": "阝", "⻐": "钅", "⻑": "長", "⻒": "镸", "⻓": "长", "⻔": "门",
    "⻖": "阝", "⻗": "雨", "⻘": "青", "⻙": "韦", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食", "⻟": "飠",
    "⻠": "饣", "⻢": "马", "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟", "⻧": "卤", "⻨": "麦", "⻩": "黄",
    "⻪": "黾", "⻫": "斉", "⻬": "齐", "⻭": "歯", "⻮": "齿", "⻯": "竜", "⻰": "龙", "⻱": "龜", "⻲": "亀",
}

#: Tasks over which the ids of one form are spread.
SALTS = 16
SAME_SHAPE_TAGS = {"", "<wide>", "<narrow>", "<noBreak>"}
#: Blocks whose <compat> decompositions keep the shape: ligatures, digraphs, Roman numerals, radicals, forms of letters.
COMPAT_BLOCKS = ((0x0132, 0x0133), (0x01C4, 0x01CC), (0x01F1, 0x01F3), (0x2002, 0x200A), (0x2160, 0x217F), (0x2E80, 0x2FDF), (0xFB00, 0xFB17), (0xFB1D, 0xFBFF))
INVISIBLE = {0x00AD, 0x034F, 0x061C, 0x180E, 0xFEFF, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), *range(0xE0000, 0xE1000)}
#: More look-alikes, as pairs of a character and what it stands for.
Shapes = tuple[tuple[str, str], ...]


def confusables(lines: Iterable[str]) -> Shapes:
    """The look-alikes of a file in the format of the published table of confusable characters:
    code point, code points that it looks like, kind, separated by semicolons."""
    out = []
    for line in lines:
        parts = line.partition("#")[0].lstrip("\ufeff").split(";")
        if len(parts) >= 2 and parts[0].strip():
            source, target = ("".join(chr(int(x, 16)) for x in p.split()) for p in parts[:2])
            if len(source) == 1:
                out.append((source, target))
    return tuple(out)


def _apart(c: int, shapes: dict[str, str]) -> str:
    """The code points that c stands for, down to ones that can't be taken apart."""
    if c in INVISIBLE:
        return ""
    ch = chr(c)
    if ch in shapes:
        return unicodedata.normalize("NFD", shapes[ch])
    if ch in RADICALS:
        return RADICALS[ch]
    if unicodedata.category(ch) == "Zs":
        return " "
    parts = unicodedata.decomposition(ch).split()
    if parts:
        tag = parts.pop(0) if parts[0][0] == "<" else ""
        if tag in SAME_SHAPE_TAGS or tag == "<compat>" and any(a <= c <= b for a, b in COMPAT_BLOCKS):
            return "".join(_apart(int(x, 16), shapes) for x in parts)
    return ch


@lru_cache(maxsize=2)
def _tables(shapes: Shapes = ()) -> CodeMap:
    known = SAME_SHAPE | dict(shapes)
    return CodeMap(lambda c: _apart(c, known))


@lru_cache(maxsize=1)
def _composites() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class of each code point, whether it joins the starter before it, pairs that compose, what they make)."""
    klass = np.zeros(TABLE, np.uint8)
    pairs = []
    for c in chain.from_iterable(MAPPED):
        klass[c] = unicodedata.combining(chr(c))
        d = unicodedata.decomposition(chr(c)).split()
        if len(d) == 2 and d[0][0] != "<" and unicodedata.normalize("NFC", chr(int(d[0], 16)) + chr(int(d[1], 16))) == chr(c):
            pairs.append(((int(d[0], 16) << 21) | int(d[1], 16), c))
    pairs.sort()
    key, made = np.array(pairs, np.uint64).T
    joins = np.zeros(TABLE, bool)
    second = (key & np.uint64((1 << 21) - 1)).astype(np.int64)
    joins[second[klass[second] == 0]] = True
    joins[0x1161:0x1176] = joins[0x11A8:0x11C3] = True
    return klass, joins, key, made.astype(np.uint32)


def _joined(a: np.ndarray, b: np.ndarray, key: np.ndarray, made: np.ndarray) -> np.ndarray:
    """The composite of each two characters, or 0."""
    want = (a.astype(np.uint64) << np.uint64(21)) | b
    at = np.minimum(np.searchsorted(key, want), len(key) - 1)
    out = np.where(key[at] == want, made[at], 0).astype(np.uint32)
    lead, vowel = a - 0x1100, b - 0x1161
    out = np.where((a >= 0x1100) & (lead < 19) & (b >= 0x1161) & (vowel < 21), 0xAC00 + (lead * 21 + vowel) * 28, out)
    syllable, tail = a - 0xAC00, b - 0x11A7
    return np.where((a >= 0xAC00) & (syllable < 11172) & (syllable % 28 == 0) & (b > 0x11A7) & (tail < 28), a + tail, out).astype(np.uint32)


def _without(gone: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(~gone, out=place[1:])
    return codes[~gone], place[starts]


def composed(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks ordered by class and put together with their bases, as the standard's composition does:
    a mark joins the last starter before it unless a mark of its class or a higher one stands between."""
    klass, joins, key, made = _composites()
    rank = klass[codes]
    first = np.zeros(len(codes) + 1, bool)
    first[starts] = True
    while len(at := np.flatnonzero(joins[codes] & ~first[:-1])):  # starters that join the starter right before them
        at = at[rank[at - 1] == 0]
        new = _joined(codes[at - 1], codes[at], key, made)
        at, new = at[new > 0], new[new > 0]
        keep = np.r_[True, np.diff(at) > 1][: len(at)]
        at, new = at[keep], new[keep]
        if not len(at):
            break
        codes = codes.copy()
        codes[at - 1] = new
        gone = np.zeros(len(codes), bool)
        gone[at] = True
        codes, starts = _without(gone, codes, starts)
        rank = klass[codes]
        first = np.zeros(len(codes) + 1, bool)
        first[starts] = True
    if not rank.any():
        return codes, starts
    base = rank == 0
    base |= first[:-1]
    group = np.cumsum(base)
    order = np.lexsort((rank, group))
    codes, rank = codes[order], rank[order]
    begin = np.flatnonzero(base)
    size = np.diff(np.append(begin, len(codes)))
    begin, size = begin[(size > 1)], size[size > 1]
    whole = rank[begin] == 0  # a text may begin with marks
    begin, size = begin[whole], size[whole]
    last = np.zeros(len(begin), np.uint8)
    gone = np.zeros(len(codes), bool)
    k = 1
    while len(begin):
        mark = begin + k
        new = np.where(last < rank[mark], _joined(codes[begin], codes[mark], key, made), 0)
        codes[begin] = np.where(new > 0, new, codes[begin])
        gone[mark] = new > 0
        last = np.where(new > 0, last, rank[mark])
        k += 1
        more = size > k
        begin, size, last = begin[more], size[more], last[more]
    return _without(gone, codes, starts)


def one_form_codes(codes: np.ndarray, starts: np.ndarray, shapes: Shapes = ()) -> tuple[np.ndarray, np.ndarray]:
    """(codes, starts) in the one form."""
    codes, starts = _tables(shapes).apply(codes, starts)
    return composed(codes, starts) if len(codes) else (codes, starts)


def one_form_column(col: pa.Array, shapes: Shapes = ()) -> pa.Array:
    """The column in the one form; null stays null."""
    out = strings(*one_form_codes(*flatten(col), shapes))
    return pc.if_else(col.is_valid(), out, pa.scalar(None, pa.string())) if col.null_count else out


def one_form(df: DataFrame, shapes: Shapes = (), **columns: str) -> DataFrame:
    """df with new columns: for each ``new="old"`` the text of old in the one form.

    shapes are look-alikes beside those known here, as confusables reads them from a file.
    Null stays null; an empty text, or one of invisible characters only, comes out empty. Other
    columns are passed on as they are; a new name that df has already replaces that column.
    """
    from pyspark.sql import types as T

    keep = [f for f in df.schema.fields if f.name not in columns]
    schema = T.StructType([*keep, *(T.StructField(new, T.StringType()) for new in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, *columns.values()):
                new = [one_form_column(part.column(old), shapes) for old in columns.values()]
                kept = [part.column(f.name) for f in keep]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[*(f.name for f in keep), *columns])

    return df.mapInArrow(run, schema)


def look_alike_classes(df: DataFrame, group: str, row_id: str, text: str) -> DataFrame:
    """(g, form, raw, ids, first_id): within each group the spellings of texts that look the same but differ in
    characters, with how many ids have each and the smallest id of the class.

    One aggregation with partial results; no ids are collected, and a form that a third of all rows
    share is a few rows here. Null groups and texts give no row, repeated rows count once.
    """
    rows = df.select(F.col(group).alias("g"), F.col(row_id).alias("id"), F.col(text).alias("raw")).where("g is not null and raw is not null and id is not null")
    each = one_form(rows, form="raw").distinct().groupBy("g", "form", "raw").agg(F.count("*").alias("ids"), F.min("id").alias("least"))
    odd = each.groupBy("g", "form").agg(F.count("*").alias("n"), F.min("least").alias("first_id")).where("n > 1").drop("n")
    return each.join(odd, ["g", "form"]).select("g", "form", "raw", "ids", "first_id")


def look_alike_rows(df: DataFrame, group: str, row_id: str, text: str) -> DataFrame:
    """(id_a, id_b): each two ids of one group whose texts look the same but differ in characters.

    Only texts that aren't in the one form can bring in a pair, so groups without such a text
    never meet in the join. Each two ids is what this gives, and a form of many ids has many of
    them: one side of the join is spread over SALTS tasks for each form and the other goes to
    each. look_alike_classes gives the same as classes. Null groups and texts give no row,
    repeated rows count once.
    """
    rows = df.select(F.col(group).alias("g"), F.col(row_id).alias("id"), F.col(text).alias("raw")).where("g is not null and raw is not null and id is not null")
    rows = one_form(rows, form="raw")
    odd = rows.where("raw <> form").select("g", "form").distinct()
    near = rows.join(odd, ["g", "form"], "left_semi").distinct()
    spread = near.select("g", "form", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"), F.col("id").alias("a"), F.col("raw").alias("raw_a"))
    each = near.select("g", "form", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.col("id").alias("b"), F.col("raw").alias("raw_b"))
    met = spread.join(each, ["g", "form", "salt"]).where("raw_a <> raw_b and a < b")
    return met.select(F.col("a").alias("id_a"), F.col("b").alias("id_b")).distinct()


def look_alike_columns(df: DataFrame, row_id: str, left: str, right: str) -> DataFrame:
    """Ids of rows whose two texts look the same but differ in characters; nulls give no row."""
    rows = df.select(F.col(row_id).alias("id"), F.col(left).alias("l"), F.col(right).alias("r")).where("l <> r")
    return one_form(rows, l="l", r="r").where("l = r").select("id").distinct()
