import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexlake.functions import html, ipa, text
from lexlake.functions.stem import porter


@pytest.mark.parametrize("a, b", [("  Café  au   LAIT ", "cafe au lait"), ("ＯＡＬＤ", "oald"), ("ˌblue-ˈblood", "blue-blood"), ("base·ment·less", "basementless"), ("", ""), ("Straße", "strasse")])
def test_lookup_form(a, b):
    assert text.lookup_form(a) == b


@given(st.text(max_size=30))
@settings(max_examples=100, deadline=None)
def test_lookup_form_is_stable(t):
    assert text.lookup_form(text.lookup_form(t)) == text.lookup_form(t)


def test_one_edit():
    out = text.one_edit("ab")
    assert {"a", "b", "ba", "abc", "xb", "cab"} <= set(out) and "ab" not in out and "" not in out and text.one_edit("a").count("") == 0


def test_paths_and_forms():
    assert text.path_form(".\\UK\\Ä.mp3") == "uk/ä.mp3" and text.path_form("//./a") == "a"
    assert text.english_form("“It’s”  A—B") == '"it\'s" a-b' and text.chinese_form("１２ 月") == "12月"


def test_columns(spark):
    df = spark.createDataFrame([("color", "colour", "X.1.mdd", "ab中文", "<p>a&amp;b</p> <i>c</i>", 3_500_000), ("kajeput", "cajuput", "x.mdx", "x", "<img src='a/b.png'><a href=\"c.css\">", 10), (None,) * 6], "a string, b string, f string, m string, h string, n long")
    en, zh = text.split_en_zh(F.col("m"))
    rows = df.select(
        text.spelled_alike(F.col("a"), F.col("b")), text.strip_ext(F.col("f")), text.volume(F.col("f")), en, zh, text.plain(F.col("h"), 4), text.linked_names(F.col("h")), text.human_size(F.col("n")),
        text.syllables(F.col("a")), text.has_cjk(F.col("m")), text.norm("a"), text.ratio("a", "b"), text.escape_html(F.col("h")), text.length_distance(F.lit(0), F.lit(1)),
    ).collect()
    assert rows[0][:6] == (False, "X", 1, "ab", "中文", "a&b…") and rows[0][7] == "3.3 MB" and rows[0][8] == 2 and rows[0][9]
    assert rows[1][0] is True and rows[1][1] == "x" and rows[1][6] == ["b.png", "c.css"] and rows[1][7] == "10 B"
    assert rows[2][10] is None and rows[2][11] is None


@pytest.mark.parametrize("w, s", [("caresses", "caress"), ("ponies", "poni"), ("running", "run"), ("hopping", "hop"), ("agreed", "agre"), ("relational", "relat"), ("conditional", "condit"), ("happy", "happi"), ("adjustable", "adjust"), ("controll", "control"), ("is", "is"), ("sky", "sky"), ("hoping", "hope"), ("adoption", "adopt")])
def test_porter(w, s):
    assert porter(w) == s


def test_html():
    page = '<div class="a" class="b">One<br>two <b>bold</b>&amp;<script>x<y</script><!-- c --></div><p></p>three'
    assert html.lines(page) == "One\ntwo bold&\nthree" and html.visible(page) == "One two bold& three"
    assert html.tokens(page)[0] == ("open", "div", {"class": "a"})
    assert html.attributes("""a="1" A='2' b=x&amp;y c""") == {"a": "1", "b": "x&y", "c": ""}
    assert html.declarations("color: red; /* x: y; */ Color:blue; f: 'a;b'") == {"color": "blue", "f": "'a;b'"}
    assert html.pairs("<p>I saw the cat. 我看见了猫。</p><p>only one</p>") == [("I saw the cat.", "我看见了猫。")]
    assert html.lines("&lt;p&gt;a&lt;/p&gt;b") == "a\nb" and html.lines("") == ""


def test_html_columns(spark):
    df = spark.createDataFrame([("<p>a</p><p>b c 中</p>",), (None,), ("",)], "h string")
    rows = df.select(html.to_lines("h"), html.visible_text("h"), html.to_tokens("h"), html.to_pairs("h")).collect()
    assert rows[0][0] == "a\nb c 中" and rows[1][:2] == (None, None) and rows[2][0] == "" and len(rows[0][2]) == 6


def test_ipa(spark):
    assert ipa.analyse("ˈrekɔːd") == {"syllables": 2, "primary": 1, "secondary": [], "segments": "rekɔːd"}
    assert ipa.analyse("rɪˈkɔːd")["primary"] == 2 and ipa.analyse("ˌfəʊtəˈɡrɑːf")["secondary"] == [1]
    assert ipa.analyse("ˈbʌtn̩")["syllables"] == 2 and ipa.analyse("ˈfaɪə")["segments"] == "faɪ.ə"
    assert ipa.analyse("-dʒekt") is None and ipa.analyse("abada") is None and ipa.analyse("") is None and ipa.analyse("kæt")["primary"] == 1
    assert ipa.contrast("juːs", "juːz") == "voicing" and ipa.contrast("estɪmət", "estɪmeɪt") == "ate" and ipa.contrast("rekɔːd", "rɪkɔːd") == "vowel" and ipa.contrast("a", "a") == "" and ipa.contrast("ab", "ak") == "segment"
    df = spark.createDataFrame([("ˈɒbdʒɪkt, -dʒekt",), (None,)], "f string")
    rows = df.select(ipa.variants(F.col("f")).alias("v"), ipa.stress("f").alias("s"), ipa.weak(F.col("f")).alias("w")).collect()
    assert rows[0].v == ["ˈɒbdʒɪkt", "-dʒekt"] and rows[1].s.syllables is None and rows[0].w == "ˈɒbdʒəkt, -dʒekt"
