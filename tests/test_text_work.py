import pytest
from pyspark.sql import functions as F

from lexlake.functions import cleaning
from lexlake.operators import choice, irregulars, marking, phrases, readings, simplified


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_cleaning(spark):
    c = cleaning
    assert c.english("· [VN] (figurative) He left 〈口〉 early .") == "He left early." and c.english("-$5 is a loss") == "-$5 is a loss" and c.english("- I suspect") == "I suspect" and c.english("a) one (= 1) two") == "one two"
    assert c.english("in 或 on") == "in or on" and c.english("") == "" and c.english("***") == ""
    assert c.chinese("①〈喻〉他走了") == "他走了" and c.chinese("【地质】板块") == "板块" and c.chinese("—5度") == "—5度"
    assert c.sentences("I met Mr. Smith. He left! Why? J. Doe knows.") == ["I met Mr. Smith.", "He left!", "Why?", "J. Doe knows."] and c.sentences("") == []
    df = spark.createDataFrame([("The cat sat here.", "猫坐在这里。"), ("cat.", "猫。"), (None, None)], "en string, zh string")
    got = df.select(c.is_english_sentence(F.col("en")), c.is_chinese_sentence(F.col("zh")), c.is_chinese_sentence(F.col("zh"), False), c.clean_english("en"), c.sentence_list("en")).collect()
    assert got[0][:3] == (True, True, True) and got[1][:3] == (False, False, False) and got[2][3] is None
    book = "x\n*** START OF THE BOOK ***\none two three four five six seven eight\n\nshort\n*** END OF THE BOOK ***\ny"
    assert spark.createDataFrame([(book,)], "t string").select(cleaning.paragraphs(F.col("t"))).first()[0] == ["one two three four five six seven eight"]


def test_levels(spark):
    page = '<h1 opal_written="y" academic="y"><span class="pos">noun</span> ox3ksym_a1</h1><ol><li class="sense" cefr="a1"><li class="sense" cefr="a1"><li class="sense" cefr="b2"></ol><h1><span class="pos">verb</span>ox5ksym_c1</h1>'
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "id long, body string")
    assert rows(readings.levels(df, "symbols")) == sorted([(1, "noun", "oxford3000", "a1", 0), (1, "noun", "opal", "written", 0), (1, "noun", "academic", "yes", 0), (1, "noun", "cefr", "a1", 2), (1, "noun", "cefr", "b2", 1), (1, "verb", "oxford5000", "c1", 0)], key=repr)
    head = '<span class="entryhead"><span class="pos">adj</span><i title="Core vocabulary: High-frequency"></i><span class="freq">S2</span><span class="ac" title="Academic Word List"></span><div class="Sense">'
    assert list(readings.bands(head)) == [("adj", "core", "high", 0), ("adj", "spoken", "S2", 0), ("adj", "awl", "yes", 0)]
    for bad in ("Core vocabulary: Odd", ):
        with pytest.raises(ValueError):
            list(readings.bands(f'<span class="entryhead"><i title="{bad}"></i>'))
    dots = "".join(f'<b class="level level{i}{" roundRed" if i < 3 else ""}"></b>' for i in range(5))
    assert list(readings.dots(dots)) == [("", "frequency_band", "3", 0)] and list(readings.dots("")) == [] and list(readings.stars('<b class="stars">★★</b>')) == [("", "stars", "2", 0)] and list(readings.frequency('<b data-band="5">')) == [("", "oed_band", "5", 0)]


def test_statements(spark):
    assert readings.misspellings("separate", "Do not write: seperate. Often misspelled as separete; fine.") == ["seperate", "separete"]
    assert readings.confused("affect", "Do not confuse it with effect. Compare infect, 2 things.") == ["affect", "effect", "infect"] and readings.confused("a", "nothing") == []
    e = spark.createDataFrame([(1, "separate", "Do not write seperate."), (2, "Separate", "Do not write seperate or separate."), (1, "affect", "Do not confuse it with effect."), (2, "effect", "Do not confuse it with affect or zzz."), (3, None, "x"), (3, "y", None)], "dict_id long, headword string, text string")
    m, c = readings.stated(e, spark.createDataFrame([("affect",), ("effect",), ("separate",)], "word string"))
    assert rows(m) == [("separate", "seperate", 2)] and rows(c) == [(["affect", "effect"], 2)]


def test_choices(spark):
    picks = spark.createDataFrame([("p1", "A", "x"), ("p2", "B", None), ("p3", "C", "")], "pick string, name string, folder string")
    records = spark.createDataFrame([("r1", "A", "x/1", 5), ("r2", "A", "y", 9), ("r3", "A", "x/2", 7), ("r4", "B", "z", 1), ("r5", "B", "w", 1)], "id string, name string, folder string, size long")
    assert rows(choice.resolved_picks(picks, records)) == [("p1", "r3"), ("p2", "r4"), ("p3", None)]
    df = spark.createDataFrame([("12",), ("x1",), ("99999999999999999999",), ("9999999999999999999",), (None,)], "t string")
    assert [r[0] for r in df.select(choice.entry_id(F.col("t"))).collect()] == [12, None, None, None, None]
    n = spark.createDataFrame([(2, 10, 200), (20, 0, 200), (0, 0, 200), (2, 3, 200)], "b int, p int, n int")
    assert [r[0] for r in n.select(choice.verdict_changes(F.col("b"), F.col("p"), F.col("n"))).collect()] == [True, False, False, False]
    judged = spark.createDataFrame([("s", 1, False, True), ("s", 2, True, False), ("s", 3, False, True)], "id string, i int, bad boolean, pending boolean")
    assert rows(choice.with_labels(judged, spark.createDataFrame([("s", 1, "bad"), ("s", 2, "good")], "id string, i int, label string"))) == [("s", 1, True, False), ("s", 2, False, False), ("s", 3, False, True)]
    a, b = choice.current_and_stale(judged, spark.createDataFrame([("s",)], "id string"))
    assert a.count() == 3 and b.count() == 0
    v = spark.createDataFrame([("s", "h", 1), ("t", "h", 1)], "id string, sha256 string, x int")
    assert rows(choice.reused(v, spark.createDataFrame([("s", "h"), ("t", "i")], "id string, sha256 string"))) == [("s", "h", 1)]
    kept = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "id string, keep boolean")
    assert rows(choice.kept_twice(kept, spark.createDataFrame([("a", "f"), ("b", "f"), ("c", "f"), ("a", "g")], "id string, file string"))) == [("f", 2)]


def test_phrases(spark):
    r = [("take off", "take off", "phrasal_verb", None), ("the north sea", "the North Sea", "phrase", "noun"), ("how come", "how come?", "phrase", None), ("debt of honour", "debt of honour", "phrase", "noun"), ("ease the helm", "ease the helm", "phrase", "noun"), ("red herring", "red herring", "phrase", "noun"), ("red herring", "red herring", "phrase", None), ("proceed to do {sth}", "proceed to do sth", "phrase", None)]
    k = phrases.kinds(spark.createDataFrame(r, "phrase string, printed string, record_kind string, pos string"))
    want = {"take off": "phrasal_verb", "the north sea": "name", "how come": "formula", "debt of honour": "compound", "ease the helm": "idiom", "red herring": "idiom", "proceed to do {sth}": "idiom"}
    assert dict(rows(k)) == want
    better = phrases.refined(k, spark.createDataFrame([("red herring",)], "headword string"), spark.createDataFrame([("proceed", "~ to-inf")], "word string, pattern string"))
    assert dict(rows(better)) == want | {"red herring": "compound", "proceed to do {sth}": "pattern"}
    df = spark.createDataFrame([(["put", "{obj}", "off"], ["x"]), (["of", "the"], []), (["be", "late"], []), (["make", "~"], ["quick", "decision"]), ([], []), (None, None)], "t array<string>, b array<string>")
    got = df.select(phrases.distinctive(F.col("t")), phrases.with_base(F.col("t"), F.col("b"))).collect()
    assert [g[0] for g in got[:5]] == [True, False, False, True, False] and got[3][1] == ["make", "~quick", "~decision"]
    v = spark.createDataFrame([(1, "off", "d1", 0, 0), (1, "take off", "d2", 1, 1), (1, "off", "d3", 2, 2), (2, "x", "d1", 0, 0)], "phrase_id long, text string, dictionary string, preference int, ord int")
    assert rows(phrases.canonical(v)) == [(1, "take off"), (2, "x")]


def test_simplified(spark):
    df = spark.createDataFrame([("馬車", "马车"), ("馬", "马"), ("車a", "车a"), ("語", "语"), ("長短", "长短x"), (None, "x")], "a string, b string")
    t = simplified.learnt(df, "a", "b")
    assert rows(t) == [("車", "车", 2), ("馬", "马", 2)]
    both = simplified.mapping(t)
    assert [r[0] for r in df.select(simplified.to_simplified(F.col("a"), both)).collect()] == ["马车", "马", "车a", "語", "長短", None]
    assert simplified.mapping(t.limit(0)) == ("", "") and df.select(simplified.to_simplified(F.col("a"), ("", ""))).count() == 6


def test_marking(spark):
    t = spark.createDataFrame([(1, 0, "saw", "VERB", 0, 3, False), (1, 1, "teh", "DET", 4, 7, False), (1, 2, "zzzz", "NOUN", 8, 12, False), (1, 3, ".", "PUNCT", 12, 13, True)], "sent_id long, i int, lower string, pos string, start int, end int, punct boolean")
    forms = spark.createDataFrame([("saw", "see", "VERB", 3), (".", ".", "PUNCT", 1)], "form string, lemma string, upos string, n int")
    facts = spark.createDataFrame([("see", "VERB", "a1", ["x"])], "word string, pos string, cefr string, labels array<string>")
    w = marking.words(t, forms, facts, spark.createDataFrame([("teh", "the")], "wrong string, word string"), spark.createDataFrame([("sea", "see")], "word_a string, word_b string"))
    got = {r.i: r for r in w.collect()}
    assert got[0].lemma == "see" and got[0].cefr == "a1" and got[0].confused_with == ["sea"] and got[1].wrong_for == ["the"] and not got[1].unknown and got[2].unknown and not got[3].unknown
    m = spark.createDataFrame([(7, 1, [0, 1, 3])], "match_id long, sent_id long, literals array<int>")
    s = marking.spans(m, t)
    assert [(r.begin, r.end, [tuple(x) for x in r.ranges]) for r in s.collect()] == [(0, 13, [(0, 7), (12, 13)])]
    f = spark.createDataFrame([(1, 0, 2, "a"), (1, 0, 1, "b"), (1, 1, 2, "c")], "sent_id long, first int, last int, x string")
    assert [r.x for r in marking.stands_alone(t, f).collect()] == ["a"]
    d = marking.documents(w, s.join(m.select("match_id", "sent_id"), "match_id"), spark.createDataFrame([(5, 1)], "doc_id long, sent_id long")).first()
    assert len(d.tokens) == 4 and len(d.spans) == 1
    assert marking.sized(spark.createDataFrame([("abc",)], "text string")).count() == 1
    with pytest.raises(Exception, match="too long"):
        marking.sized(spark.createDataFrame([("abc",)], "text string"), most=2).collect()
    gold = spark.createDataFrame([(1, 1, 1, 0, 1), (2, 1, 1, 2, 3), (3, 9, 1, 0, 0), (4, 2, 1, 0, 0)], "gold_id long, item_id long, sent_id long, first int, last int")
    found = spark.createDataFrame([(1, 1, 0, 1), (1, 1, 3, 5)], "item_id long, sent_id long, first int, last int")
    assert rows(marking.recall(gold, found, spark.createDataFrame([(1,), (2,)], "item_id long"))) == [("exact", 1), ("not compiled", 1), ("not found", 1), ("words", 1)]
    p = marking.stratified(spark.createDataFrame([("a", True), ("a", False), ("b", True)], "tier string, right boolean"), spark.createDataFrame([("a", 30), ("b", 10)], "tier string, n long"))
    assert p.first()[0] == 0.625
    k = spark.createDataFrame([(["which_word"], 1), (["confused"], 1), (["confused"], 2), (["sound_alike"], 9)], "k array<string>, n int")
    assert [r[0] for r in k.select(marking.notable(F.col("k"), F.col("n"))).collect()] == [True, False, True, False]


def test_chosen_sources(spark):
    columns = "id string, status string, english int, foreign int, en_zh double, n_en_zh int, zh_en double, n_zh_en int"
    null = None
    probes = spark.createDataFrame([('a', 'ok', 50, 2, 0.7, 40, 0.2, 40), ('b', 'ok', 5, 60, 0.7, 40, 0.1, 9), ('c', 'ok', 50, 0, 0.9, 3, 0.5, 30), ('d', 'ok', 50, 0, 0.35, 20, 0.34, 30), ('e', 'unreadable', 0, 0, null, null, null, null), ('f', 'ok', 9, 0, 0.1, 9, null, null), ('g', 'ok', 9, 0, 0.5, 4, 0.4, 4)], columns)
    got = choice.choose(probes, spark.createDataFrame([("f", "styled"), ("e", "styled")], "id string, extractor string"))
    true, false = True, False
    assert rows(got.select("id", "keep", "reading", "extractor", "reason")) == sorted([('a', true, 'en-zh', 'text', ''), ('b', false, 'en-zh', 'text', 'mostly another language'), ('c', true, 'zh-en', 'text', ''), ('d', false, 'en-zh', 'text', 'not clearly translations'),
        ('e', false, 'en-zh', 'text', 'unreadable'), ('f', true, 'en-zh', 'styled', 'not clearly translations'), ('g', false, 'en-zh', 'text', 'too few scored pairs')])


def test_judged_forms(spark):
    attested = [('take', 'verb', 'Past', 'took', 'd1'), ('take', 'verb', 'Past', 'took', 'd2'), ('take', 'verb', 'Past', 'took', 'd3'), ('sing', 'verb', 'Past', 'sang', 'd1'), ('forget', 'verb', 'PresPart', 'forgeting', 'd1'), ('walk', 'verb', 'Past', 'walked', 'd1'),
    ('man', 'noun', 'Plur', 'men', 'd1'), ('pita', 'noun', 'Plur', 'pitta', 'd1'), ('defog', 'verb', 'Past', 'demist', 'd1'), ('go', 'verb', 'Past', 'went', 'd1'), ('big', 'adjective', 'Cmp', 'bigger', 'd1'), ('teach', 'verb', 'Past', 'taught', 'd1'), ('sheep', 'noun', 'Plur', 'sheep', 'd2')]
    got = irregulars.judged(spark.createDataFrame(attested, "lemma string, pos string, slot string, form string, dictionary string"))
    assert rows(got.select("lemma", "pos", "slot", "form", "n", "kind")) == sorted([('take', 'verb', 'Past', 'took', 3, 'irregular'), ('sing', 'verb', 'Past', 'sang', 1, 'thin'), ('forget', 'verb', 'PresPart', 'forgeting', 1, 'regular'), ('walk', 'verb', 'Past', 'walked', 1, 'regular'),
        ('man', 'noun', 'Plur', 'men', 1, 'thin'), ('pita', 'noun', 'Plur', 'pitta', 1, 'doubtful'), ('defog', 'verb', 'Past', 'demist', 1, 'doubtful'), ('go', 'verb', 'Past', 'went', 1, 'thin'), ('big', 'adjective', 'Cmp', 'bigger', 1, 'regular'),
        ('teach', 'verb', 'Past', 'taught', 1, 'thin'), ('sheep', 'noun', 'Plur', 'sheep', 1, 'thin')])
