import unicodedata

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lexlake.llm.codes import MAPPED, flatten, strings
from lexlake.llm.lookalike import composed, confusables, look_alike_classes, look_alike_columns, look_alike_rows, one_form, one_form_column

SAME = [
    ("ＯＡＬＤ", "OALD"), ("gav‌api", "gavapi"), ("mesikofüs", "mesikofüs"), ("ﬁfth", "fifth"), ("﻿⻅⼀", "见一"), ("a b", "a b"),
    ("сосоа", "cocoa"), ("ạ́", "ạ́"), ("각", unicodedata.normalize("NFD", "각")), ("co‑op", "co-op"), ("里", "里"), ("ï", "ї"),
]
DIFFERENT = [("Polish", "polish"), ("resume", "résumé"), ("x²", "x2"), ("①", "1"), ("語", "语"), ("color", "colour"), ("-", "—"), ("ß", "ss")]


def form(*texts):
    return one_form_column(pa.array(texts, pa.string())).to_pylist()


def test_pairs():
    for a, b in SAME:
        assert len(set(form(a, b))) == 1, (a, b)
    for a, b in DIFFERENT:
        assert len(set(form(a, b))) == 2, (a, b)
    assert form(None, "", "​") == [None, "", ""]


@given(st.lists(st.text(max_size=12), max_size=8))
@settings(max_examples=150, deadline=None)
def test_laws(texts):
    once = form(*texts)
    assert form(*once) == once
    assert form(*(unicodedata.normalize("NFD", t) for t in texts)) == once
    assert [form(t)[0] for t in texts] == once


def test_rows_and_columns(spark):
    rows = [(1, 7, "ab", 1), (2, 7, "a​b", 1), (3, 7, "ab", 1), (4, 8, "аb", 1), (5, 7, None, 1), (2, 7, "a​b", 1), (6, None, "a​b", 1), (7, 7, "Ab", 1)]
    df = spark.createDataFrame(rows, "id long, d long, raw string, form int")
    assert sorted(map(tuple, look_alike_rows(df, "d", "id", "raw").collect())) == [(1, 2), (2, 3)]
    assert look_alike_rows(df.limit(0), "d", "id", "raw").count() == 0
    two = spark.createDataFrame([(1, "a", "а"), (2, "a", "a"), (3, None, "a"), (4, "a", "b"), (1, "a", "а")], "id long, l string, r string")
    assert [r.id for r in look_alike_columns(two, "id", "l", "r").collect()] == [1]
    long = spark.createDataFrame([("x", "é" * 300_000)], "a string, b string")
    assert one_form(long, b="b").first().b == "é" * 300_000


def test_all_of_unicode():
    """Every character equals its canonical decomposition, those beyond the first planes too."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert form(*every) == form(*(unicodedata.normalize("NFD", c) for c in every)) == form(*(unicodedata.normalize("NFC", c) for c in every))
    assert form("\U0002F804") == ["\u4f60"] and form("\U0002A700", "\U00030000", "\U000F0000") == ["\U0002A700", "\U00030000", "\U000F0000"] and form("a\U000E0101") == ["a"]


def test_nothing_else_is_mapped():
    """What the tables leave out has neither case nor decomposition."""
    for c in set(range(0x20000, 0x110000)) - {x for r in MAPPED for x in r}:
        assert not unicodedata.decomposition(chr(c)) and not unicodedata.combining(chr(c)) and chr(c).casefold() == chr(c) and unicodedata.category(chr(c)) in ("Lo", "Co", "Cn")


@given(st.text(alphabet="aegDLo\u0300\u0301\u0302\u0307\u0323\u0327\u0328\u0338\u1100\u1161\u11a8\u09c7\u09be\u0cc6\u0cc2\u0cd5\u0dd9\u0dca\u0dcf\u05d0\u05b7\u05bc", max_size=14))
@settings(max_examples=400, deadline=None)
def test_standard_composition(text):
    want = unicodedata.normalize("NFC", text)
    codes, starts = composed(*flatten(pa.array([unicodedata.normalize("NFD", text), "x"])))
    assert strings(codes, starts).to_pylist() == [want, "x"]


def test_confusables_file():
    lines = ["\ufeff# a comment", "0430 ;\t0061 ;\tMA\t# x", "", "1D5BA ; 0061 ; MA", "06E5 0307; 0061; MA"]
    shapes = confusables(lines)
    assert shapes == (("\u0430", "a"), ("\U0001d5ba", "a"))
    assert one_form_column(pa.array(["\U0001d5ba", "Ꭺα"]), shapes).to_pylist() == ["a", "Aa"] and form("\U0001d5ba") == ["\U0001d5ba"]


def test_classes(spark):
    rows = [(i, 7, ("ab", "a\u200bb", "\u0430b")[i % 3], 1) for i in range(30)] + [(90, 7, "zz", 1), (91, 8, "ab", 1), (92, None, "ab", 1), (93, 7, None, 1), (0, 7, "ab", 1)]
    df = spark.createDataFrame(rows, "id long, d long, raw string, form int")
    got = look_alike_classes(df, "d", "id", "raw").collect()
    assert sorted((r.raw, r.ids, r.first_id) for r in got) == sorted([("ab", 10, 0), ("a\u200bb", 10, 0), ("\u0430b", 10, 0)])
    assert look_alike_rows(df, "d", "id", "raw").count() == 300
