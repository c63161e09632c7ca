import datetime as dt
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from lexlake.functions import notation, pos, spelling
from lexlake.operators import families, folders
from lexlake.operators.once import numbered, once
from lexlake.streaming.listings import follow, windows


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_numbers_over_spans(spark, monkeypatch):
    monkeypatch.setattr("lexlake.operators.once.SPAN", 10)
    r = random.Random(1)
    data = [(i, r.choice(["a", "a", "b", None])) for i in r.sample(range(500), 200)]
    want = defaultdict(list)
    for i, k in sorted(data):
        want[k].append(i)
    got = numbered(spark.createDataFrame(data, "id long, k string"), ["k"], "id", "n")
    assert got.columns == ["id", "k", "n"] and rows(got) == sorted(((i, k, n) for k, v in want.items() for n, i in enumerate(v, 1)), key=repr)
    assert rows(once(spark.createDataFrame([(1, None), (1, None), (None, "x")], "id long, k string"), "id")) == [(1, None), (None, "x")]


def test_spelling(spark):
    pairs = [("colour", "color", True), ("centre", "center", True), ("organise", "organize", True), ("programme", "program", True), ("judgement", "judgment", True), ("anaemia", "anemia", True), ("fulfil", "fulfill", True), ("grey", "gray", True), ("foot", "feet", False), ("a", "a", False)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert df.where(spelling.is_variant(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    r = spark.createDataFrame([("colour", "color"), ("center", "centre"), ("x", "y"), (None, "a")], "a string, b string").select(spelling.regions(F.col("a"), F.col("b")).alias("r")).collect()
    assert [tuple(x.r) for x in r] == [("GB", "US"), ("US", "GB"), ("", ""), ("", "")]


def test_pos(spark):
    cases = {"noun": (["NOUN"], {}), "N-COUNT": (["NOUN"], {"Countability": "Count"}), "tr. & intr.v.": (["VERB"], {"Transitivity": "Both"}), "adj.2": (["ADJ"], {}), "noun suffix": (["X"], {"Kind": "Suffix"}), "xyz": ([], {}), "": ([], {}), "subordinating conjunction": (["SCONJ"], {}), "名词": (["NOUN"], {})}
    for printed, (tags, features) in cases.items():
        assert pos.read(printed) == {"tags": tags, "features": features}, printed
    got = spark.createDataFrame([("noun",), (None,)], "p string").select(pos.pos_of("p").alias("x")).collect()
    assert got[0].x.tags == ["NOUN"] and got[1].x.tags is None


def test_notation(spark):
    v = lambda p, h="": [" ".join(x) for x in notation.variants(p, h)]
    assert v("be/go out like a light") == ["be out like a light", "go out like a light"]
    assert v("take a ~ at", "look") == ["take a look at"] and v("how about…?") == ["how about {...}"]
    assert v("(as) easy as pie") == ["easy as pie", "as easy as pie"] and v("let it drop (or rest)") == ["let it drop", "let it rest"]
    assert v("put somebody/something off") == ["put {sb/sth} off"] and notation.separable(("put", "{sb/sth}", "off"))
    assert v("to jack sth up or to jack up sth") == ["jack {sth} up", "jack up {sth}"] and v("change his/her mind") == ["change {one's} mind"]
    assert v("") == [] and len(v("(a) (b) (c) (d) (e) (f) (g)")) == notation.MAX_VARIANTS
    assert list(notation.orders(("put", "{sth}", "off"))) == [("put", "{sth}", "off"), ("put", "off", "{sth}")]
    assert notation.is_phrase(("take", "off")) and not notation.is_phrase(("the", "woman")) and notation.is_phrase(("off-the-cuff",))
    got = spark.createDataFrame([("put sb off",), (None,)], "p string").select(notation.read_notation("p").alias("x")).collect()
    assert got[0].x.separable and got[1].x.separable is None


def test_relations_and_families(spark):
    r = families.relation
    assert [r("decide", "decision"), r("reserve", "reservation"), r("decided", "undecided"), r("run", "runner"), r("night club", "nightclub"), r("fibre", "fibreboard", words=frozenset({"board"})), r("icebreaker", "icebreaking"), r("re-", "refocus"), r("walk", "walk"), r("walk", "walked", frozenset({"walked"})), r("cat", "dog"), r("strip", "strip map")] == [
        "suffixed", "suffixed", "prefixed", "suffixed", "variant", "compound", "sibling", "prefixed", "conversion", "inflection", "related", "compound",
    ]
    links = spark.createDataFrame([("decide", "decision"), ("decide", "decided"), ("decided", "undecided"), ("fibre", "fibreboard"), ("colour", "color"), ("re-", "refocus"), ("decide", "decision"), (None, "x")], "base string, member string")
    read = families.related(links, spark.createDataFrame([("decide", "decided")], "lemma string, form string"), spark.createDataFrame([("board",)], "word string"))
    assert rows(read) == [("colour", "color", "variant"), ("decide", "decided", "inflection"), ("decide", "decision", "suffixed"), ("decided", "undecided", "prefixed"), ("fibre", "fibreboard", "compound"), ("re-", "refocus", "prefixed")]
    assert rows(families.families(read)) == [("color", "color"), ("colour", "color"), ("decide", "decide"), ("decided", "decide"), ("decision", "decide"), ("undecided", "decide")]


def test_folders(spark):
    files = [("one", n, s) for n, s in (("A.mdx", 5), ("a.mdd", 2), ("A.1.mdd", 3), ("style.css", 1), ("other.txt", 9))]
    files += [("two", n, s) for n, s in (("A.mdx", 5), ("B.mdx", 6), ("b.css", 1), ("x.css", 1), ("pack.mdd", 4), ("pack.1.mdd", 4), ("z.part1.rar", 7), ("z.part2.rar", 8), ("z.zip", 3), ("q.1.mdx", 2), ("q.1.mdd", 1))]
    got = rows(folders.records(spark.createDataFrame(files + files[:2] + [(None, "a.mdx", 1), ("n", None, 1)], "folder string, name string, size long")))
    assert got == sorted([
        ("one", "mdx", "A.mdx", 5, 11, 4, True), ("two", "mdx", "A.mdx", 5, 5, 1, False), ("two", "mdx", "B.mdx", 6, 7, 2, False), ("two", "mdd", "pack.mdd", 4, 8, 2, True),
        ("two", "archive", "z.part1.rar", 7, 15, 2, False), ("two", "archive", "z.zip", 3, 3, 1, False), ("two", "mdx", "q.1.mdx", 2, 3, 2, True),
    ], key=repr)
    found = folders.records(spark.createDataFrame(files, "folder string, name string, size long"))
    assert ("mdx", "a.mdx", 5, 2, 11) in rows(folders.merged(found))
    assert folders.shrunk(found, found.limit(2)).count() == 1 and folders.shrunk(found, found).count() == 0


def test_listing_stream(spark, tmp_path):
    schema = "snapshot_no int, id string, name string, size long, date string, locations array<struct<folder:string,files:array<struct<name:string,size:long>>,main_name:string,main_size:long>>, loaded_at timestamp"
    row = lambda no, key, size=1: (no, key, "n", size, "2024-01-05", [], dt.datetime(2024, 1, 1))
    put = lambda rows_: spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: follow(spark, *(str(tmp_path / x) for x in ("in", "state", "out", "check"))).awaitTermination()
    put([row(1, "a"), row(1, "b")])
    run()
    put([row(2, "a", 5), row(2, "c")])
    run()
    put([row(4, "a", 5), row(4, "c")])
    run()
    got = rows(spark.read.parquet(str(tmp_path / "out")).select("snapshot_no", "id", "change"))
    assert got == [(2, "a", "changed"), (2, "b", "removed"), (2, "c", "added")]


def test_windows(spark, small):
    from lexlake.session import table

    e = table(spark, small, "events")
    got = windows(e.limit(500))
    assert got.agg(F.sum("n")).first()[0] == 500 and re.fullmatch(r"\w+", got.first().kind)
