import random
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lexlake.llm.codes import flatten
from lexlake.llm.copies import collapsed, copies, same_texts, text_hashes

SCHEMA = "id long, en string, zh string, first_id long, k1 long, salt string, a int"
SKIP = {"Zs", "Zl", "Zp", "Cc", "Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po"}


def bare(t):
    return None if t is None else "".join(c for c in t.casefold() if unicodedata.category(c) not in SKIP)


def brute(rows):
    groups = defaultdict(set)
    for r in rows:
        groups[tuple(sorted((bare(r[1]), bare(r[2])), key=lambda x: (x is None, x)))].add(r[0])
    return sorted((min(g), i) for g in groups.values() for i in g if i != min(g))


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 5, 5, "s", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, copies(df, "id", "en", "zh", **more).collect()))


ROWS = [
    (1, "Hello, world", "你好。"), (2, "hello WORLD!", "你 好"), (3, "你好", "«Hello — world»"), (4, "hello", "world 你好"),
    (5, None, "你好"), (6, "", "你好"), (7, None, "你好。"), (8, "…", "你好"), (9, "Straße", "x"), (10, "STRASSE", "x"),
    (11, None, None), (12, None, None), (13, "a" * 70_000, "b"), (14, "A" * 70_000, "b"), (15, "a b", "c d"), (16, "ab", "cd"), (17, "abc", "d"),
]


def test_against_brute_force(spark):
    assert run(spark, ROWS + ROWS[:5]) == brute(ROWS)


def test_hot_key_is_split(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["A b", "a,B", "ab"]), "中 文") for i in range(400)] + [(1000 + i, f"w{i % 50}", "x") for i in range(200)]
    r.shuffle(rows)
    assert run(spark, rows + rows[:50], hot_rows=100) == brute(rows)


def test_collision_is_told_apart(spark, monkeypatch):
    import pyarrow as pa

    from lexlake.llm.copies import _groups

    batch = pa.RecordBatch.from_pydict(
        {"k1": [1] * 5, "k2": [1] * 5, "salt": [-1] * 5, "id": [1, 2, 3, 4, 5], "a": ["x", "y", "X", "y!", "z"], "b": ["q"] * 5},
        schema=pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("salt", pa.int64()), ("id", pa.int64()), ("a", pa.string()), ("b", pa.string())]),
    )
    parts = [batch.slice(0, 3), batch.slice(3, 2)]
    out = [(f, c) for b in _groups(iter(parts)) for f, c in zip(b.column("first_id").to_pylist(), b.column("copy_id").to_pylist())]
    assert sorted(out) == [(1, 3), (2, 4)]


@given(st.lists(st.text(alphabet="aAsSßẞİ .,!-中ﬀéé", max_size=6), min_size=2, max_size=12))
@settings(max_examples=300, deadline=None)
def test_hash_and_pointers(texts):
    col = pa.array(texts)
    n = len(texts)
    a, b = np.repeat(np.arange(n), n), np.tile(np.arange(n), n)
    want = [bare(texts[i]) == bare(texts[j]) for i, j in zip(a, b)]
    assert same_texts(*flatten(col), a, b).tolist() == want
    h = text_hashes(col)
    assert [bool(h[0][i] == h[0][j] and h[1][i] == h[1][j]) for i, j in zip(a, b)] == want


def test_long_texts():
    base = "ß, word " * 40_000
    col = pa.array([base, base.upper().replace(" ", "  "), base + "x", base[:-9] + "q word"])
    assert same_texts(*flatten(col), np.array([0, 0, 0, 2]), np.array([1, 2, 3, 2])).tolist() == [True, False, False, True]


def test_counts_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "A", "b."), (3, "c", "d"), (3, "c", "d")], "id long, en string, zh string")
    assert sorted(map(tuple, collapsed(df, "id", "en", "zh").collect())) == [(1, 2), (3, 1)]
    assert run(spark, []) == []
