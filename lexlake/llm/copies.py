"""Problem 4: records that are the same but for white space, case, punctuation or field order.

Each text is read once through a table that says of every code point how much it adds to rolling
polynomial hashes and by how many places it moves them on: nothing for what is skipped, the folded
letters for the others. No canonical string is made. Records that share their key are sorted next
to each other and compared with the first of their group by two pointers that skip, so that a
collision of hashes can't merge different records.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.codes import CodeMap, chunks, flatten, mix, powers
from lexlake.session import cut_lineage

#: A key with more rows than this is split over SALTS tasks.
HOT_ROWS = 50_000
SALTS = 64
KEYS = "k1 long, k2 long, swapped boolean"
#: Steps that pairs of texts are compared side by side, and characters of a block of those compared alone.
STEPS, BLOCK = 2_000, 65_536
NULL = np.uint64(0x6E756C6C6E756C6C)


@lru_cache(maxsize=1)
def fold_table() -> CodeMap:
    """Skips white space, punctuation and control characters; folds case."""
    skip = {"Zs", "Zl", "Zp", "Cc", "Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po"}
    return CodeMap(lambda c: "" if unicodedata.category(chr(c)) in skip else chr(c).casefold())


@lru_cache(maxsize=2)
def _weights(seed: int) -> np.ndarray:
    """What each code point adds to a polynomial hash where its first folded letter stands at power 0."""
    table, power = fold_table(), powers(seed, 4)
    with np.errstate(over="ignore"):
        out = np.where(table.size > 0, mix(table.first, seed), np.uint64(0))
        for c in np.flatnonzero(table.many):
            n = int(table.size[c])
            letters = table.pool[table.offset[c] : table.offset[c] + n]
            out[c] = (mix(letters, seed) * power[:n]).sum()
    return out


def text_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text as read through the table; null has hashes of its own."""
    codes, starts = flatten(col)
    place = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(fold_table().size[codes], out=place[1:])
    size = place[starts[1:]] - place[starts[:-1]]
    place = place[:-1] - np.repeat(place[starts[:-1]], np.diff(starts))
    bits = max(4, (int(size.max()) if len(size) else 0).bit_length())
    out = []
    with np.errstate(over="ignore"):
        for seed in (0, 1):
            total = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(_weights(seed)[codes] * powers(seed, bits)[place], out=total[1:])
            out.append(mix((total[starts[1:]] - total[starts[:-1]]) ^ mix(size.astype(np.uint64), seed + 11), seed))
    if col.null_count:
        gone = ~col.is_valid().to_numpy(zero_copy_only=False)
        out = [np.where(gone, NULL, h) for h in out]
    return out[0], out[1]


def record_key(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit key of the unordered two texts, and whether the right one came first."""
    (a1, a2), (b1, b2) = text_hashes(left), text_hashes(right)
    swapped = (b1 < a1) | ((b1 == a1) & (b2 < a2))
    lo1, hi1 = np.where(swapped, b1, a1), np.where(swapped, a1, b1)
    lo2, hi2 = np.where(swapped, b2, a2), np.where(swapped, a2, b2)
    with np.errstate(over="ignore"):
        return mix(lo1 + mix(hi1, 3), 5).view(np.int64), mix(lo2 + mix(hi2, 7), 9).view(np.int64), swapped


def keyed(df: DataFrame, left: str, right: str, texts: bool) -> DataFrame:
    """df with the record key; without the texts only the key stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, left, right):
                k1, k2, swapped = record_key(part.column(left), part.column(right))
                new = [pa.array(k1), pa.array(k2), pa.array(swapped)]
                if texts:
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "k1", "k2", "swapped"])
                else:
                    yield pa.RecordBatch.from_arrays(new, names=["k1", "k2", "swapped"])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), KEYS]) if texts else KEYS
    return df.mapInArrow(run, schema)


def same_texts(codes: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the texts at a[k] and b[k] are the same for every k, read through the table.

    Two pointers run over the texts as they are; each skips what doesn't count and waits where the
    other skips. The pairs run side by side, those still running after STEPS steps one by one.
    """
    table = fold_table()
    codes = codes if len(codes) else np.zeros(1, np.uint32)
    out = np.ones(len(a), bool)
    run = np.arange(len(a))
    at, end = (np.stack([x[a], x[b]]) for x in (starts[:-1], starts[1:]))
    inner = np.zeros_like(at)  # the place within the folded letters of one character
    for _ in range(STEPS):
        if not len(run):
            return out
        here = at < end
        c = codes[np.where(here, at, 0)]
        size = np.where(here, table.size[c], 1)
        skip = size == 0
        at[skip] += 1
        both = ~skip.any(axis=0)
        letter = np.where(size > 1, table.pool[np.where(size > 1, table.offset[c] + inner, 0)], table.first[c])
        differ = both & ((here[0] != here[1]) | here[0] & here[1] & (letter[0] != letter[1]))
        out[run[differ]] = False
        go = both & here
        inner += go
        done = go & (inner >= size)
        at += done
        inner[done] = 0
        left = ~differ & (skip.any(axis=0) | here.any(axis=0))
        if not left.all():
            run, at, end, inner = run[left], at[:, left], end[:, left], inner[:, left]
    for k in run.tolist():
        out[k] = _same_long(codes[starts[a[k]] : starts[a[k] + 1]], codes[starts[b[k]] : starts[b[k] + 1]])
    return out


def _same_long(a: np.ndarray, b: np.ndarray) -> bool:
    """same_texts of two long texts, in blocks of BLOCK characters."""
    table, at, rest = fold_table(), [0, 0], [np.empty(0, np.uint32)] * 2
    while True:
        for side, text in enumerate((a, b)):
            while not len(rest[side]) and at[side] < len(text):
                part = text[at[side] : at[side] + BLOCK]
                rest[side] = table.apply(part, np.array([0, len(part)]))[0]
                at[side] += len(part)
        n = min(len(rest[0]), len(rest[1]))
        if not n:
            return not len(rest[0]) and not len(rest[1])
        if (rest[0][:n] != rest[1][:n]).any():
            return False
        rest = [r[n:] for r in rest]


class _Pointers:
    """The texts of a batch of records, as they stand."""

    def __init__(self, first: pa.Array, second: pa.Array):
        self.texts = [(*flatten(col), ~col.is_valid().to_numpy(zero_copy_only=False)) for col in (first, second)]

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the records at a and b are the same, both texts read side by side."""
        out = np.ones(len(a), bool)
        for codes, starts, null in self.texts:
            ask = np.flatnonzero(out & (a != b))
            one, two = a[ask], b[ask]
            same = null[one] == null[two]
            same[same] = same_texts(codes, starts, one[same], two[same])
            out[ask] = same
        return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first_id, copy_id, k1, k2, a, b) of rows sorted by key and id; a, b: texts of firsts of salted keys."""
    carried: pa.RecordBatch | None = None  # the different records seen so far of the last key

    def emit(part: pa.RecordBatch, owner: np.ndarray, at: np.ndarray, firsts: np.ndarray) -> pa.RecordBatch:
        ids = part.column("id").to_numpy(zero_copy_only=False)
        salted = part.column("salt").to_numpy(zero_copy_only=False) >= 0
        rows = at[(ids[owner[at]] != ids[at]) | (salted[at] & firsts[at])]  # not an id delivered again
        show = pa.array(firsts[rows] & salted[rows])
        none = pa.scalar(None, pa.string())
        take = part.take(pa.array(rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[owner[rows]]), pa.array(ids[rows]), take.column("k1"), take.column("k2"), pc.if_else(show, take.column("a"), none), pc.if_else(show, take.column("b"), none), pa.array(salted[rows])],
            names=["first_id", "copy_id", "k1", "k2", "a", "b", "salted"],
        )

    for batch in batches:
        for part in chunks(batch, "a", "b"):
            n_old = 0
            if carried is not None:
                n_old = carried.num_rows
                part = pa.Table.from_batches([carried, part]).combine_chunks().to_batches()[0]
            k1, k2, salt = (part.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "salt"))
            n = len(k1)
            new = np.ones(n, bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (salt[1:] != salt[:-1])
            owner = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            pointers = _Pointers(part.column("a"), part.column("b"))
            rest = np.flatnonzero(~pointers.same(np.arange(n), owner))
            other: dict[int, list[int]] = {}
            for i in rest:  # a collision, or a second record carried over
                mine = other.setdefault(int(owner[i]), [])
                hit = next((j for j in mine if pointers.same(np.array([i]), np.array([j]))[0]), None)
                if hit is None:
                    mine.append(int(i))
                owner[i] = int(i) if hit is None else hit
            at = np.arange(n_old, n)
            yield emit(part, owner, at, owner == np.arange(n))
            last = owner[n - 1] if new[n - 1] else np.maximum.accumulate(np.where(new, np.arange(n), 0))[n - 1]
            carried = part.take(pa.array(sorted({int(last), *other.get(int(last), [])})))


def copies(df: DataFrame, row_id: str, left: str, right: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(first_id, copy_id): each record but the first (smallest id) of its group of copies.

    Copies have the same two texts once white space, letter case and punctuation are set aside,
    whichever column holds which. A null text equals null only, an empty text or one of
    punctuation only equals any other such. An id that is delivered again counts once. Rows
    without id give none. The key counts, summed before the shuffle, tell the hot keys; there
    are at most rows / hot_rows of them. They alone are split over SALTS tasks, whose firsts are
    then compared with each other.
    """
    rows = df.select(F.col(row_id).alias("id"), F.col(left).alias("a"), F.col(right).alias("b")).where("id is not null")
    counts = keyed(rows.select("a", "b"), "a", "b", texts=False).groupBy("k1").count()
    hot = [r.k1 for r in counts.where(F.col("count") > hot_rows).select("k1").collect()]
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(-1) if hot else F.lit(-1).cast("long")
    keys = keyed(rows, "a", "b", texts=True)
    if hot:  # 8 bytes for each key that has more than hot_rows rows
        keys = keys.join(F.broadcast(df.sparkSession.createDataFrame([(k, True) for k in hot], "k1 long, hot boolean")), "k1", "left")
    ordered = keys.select(
        "k1", "k2", salt.cast("long").alias("salt"), "id",
        F.when(F.col("swapped"), F.col("b")).otherwise(F.col("a")).alias("a"),
        F.when(F.col("swapped"), F.col("a")).otherwise(F.col("b")).alias("b"),
    )
    near = ordered.repartition("k1", "salt").sortWithinPartitions("k1", "k2", "salt", "id")
    found = near.mapInArrow(_groups, "first_id long, copy_id long, k1 long, k2 long, a string, b string, salted boolean")
    if not hot:
        return found.select("first_id", "copy_id").distinct()
    found = cut_lineage(found)
    firsts = found.where("salted and first_id = copy_id").select("k1", "k2", F.lit(0).cast("long").alias("salt"), F.col("first_id").alias("id"), "a", "b")
    merged = firsts.repartition("k1").sortWithinPartitions("k1", "k2", "salt", "id").mapInArrow(_groups, found.schema)
    top = merged.select(F.col("copy_id").alias("first_id"), F.col("first_id").alias("top"))
    split = found.where("salted").join(F.broadcast(top), "first_id")  # at most SALTS rows for each hot key
    return (
        found.where("not salted").select("first_id", "copy_id")
        .unionByName(split.where("top <> copy_id").select(F.col("top").alias("first_id"), "copy_id"))
        .distinct()
    )


def collapsed(df: DataFrame, row_id: str, left: str, right: str) -> DataFrame:
    """(first_id, copies): one row for each record, with how many deliveries it stands for."""
    found = copies(df, row_id, left, right)
    n = found.groupBy("first_id").agg(F.count("*").alias("more"))
    ids = df.select(F.col(row_id).alias("first_id")).where("first_id is not null").distinct()
    return ids.join(found.select(F.col("copy_id").alias("first_id")), "first_id", "left_anti").join(n, "first_id", "left").select("first_id", (F.coalesce("more", F.lit(0)) + 1).alias("copies"))
