import random

from lexlake.llm import language as L

EN = "the cat sat on the old mat,when it rains the door stays open,nobody knows why the lamp is broken,she has never seen such a thing before,we found the letters in the kitchen".split(",")
DE = "die katze sass auf der alten matte,wenn es regnet bleibt die tür offen,niemand weiss warum die lampe kaputt ist,sie hat so etwas noch nie gesehen,wir fanden die briefe in der küche".split(",")
ZH = "猫坐在旧垫子上,下雨的时候门开着,没有人知道灯为什么坏了,她从来没见过这样的东西,我们在厨房里找到了信".split(",")
DOCS = "doc_id long, text string, lang string, tbl int"
PAIRS = "id long, en string, zh string, lang int"
SNAPS = "snapshot_no int, id string, name string, lang string, text int"


def corpus():
    r, rows = random.Random(5), []
    for code, own, end in (("en", EN, ". "), ("de", DE, ". "), ("zh", ZH, "。")):
        for _ in range(40):
            rows.append((len(rows), end.join(r.sample(own, 4)) + end, code, 1))
    return rows


def snapshots():
    out = []
    for i in range(30):
        for key, rest, label in (("a", "English Dictionary", "en-en"), ("b", "English-Chinese Dictionary", "en-zh"), ("c", "Dictionnaire du français", "other"), ("d", "German-English Dictionary", "en-other")):
            word = key + "bdfgk"[i % 5] + "aeiou"[i // 5 % 5] + chr(97 + i % 26) + "zul"
            out.append((1, f"{key}{i}", f"{word} {rest}" + " Plus" * (i % 10 == 0), "other" if i == 7 else label, 1))
    return out


def test_documents_sides_and_names(spark):
    docs = corpus() + [
        (900, ". ".join(EN[:3]) + ".", "de", 1), (901, ". ".join(EN[:2]) + ". " + DE[2] + ".", "en", 1), (902, ". ".join(DE[:2]) + ".", None, 1), (903, ". ".join(DE[:3]) + ".", "German", 1),
        (904, EN[0] + " (die katze). " + EN[1] + ".", "en-GB", 1), (905, "", "en", 1), (906, None, None, 1), (907, ZH[0] + "。" + DE[1] + "。", "zh", 1), (908, "12 345", None, 1), (909, (EN[0] + ". ") * 4000, "en", 1),
    ]
    pairs = [(i, EN[i % 5], ZH[i % 5], 1) for i in range(40)] + [(50, ZH[1], EN[1], 1), (51, DE[0], ZH[0], 1), (52, None, "", 1), (50, ZH[1], EN[1], 1)]
    snaps = snapshots() + [(2, "x1", "nomo English Dictionary", None, 1), (2, "x2", "rika English-Chinese Dictionary", "other", 1), (3, "x2", "rika English-Chinese Dictionary", "other", 1), (2, "x3", "pulo Dictionnaire du français", "unknown", 1), (2, "x4", None, None, 1)]
    got = L.found(spark.createDataFrame(docs, DOCS), spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(snaps, SNAPS))
    assert sorted(map(tuple, got.collect())) == sorted([
        ("documents", "900", "en"), ("documents", "901", "de"), ("documents", "901", "en"), ("documents", "902", "de"), ("documents", "907", "de"), ("documents", "907", "zh"),
        ("record_snapshot", "a7", "en-en"), ("record_snapshot", "b7", "en-zh"), ("record_snapshot", "d7", "en-other"), ("pair.en", "50", "zh"), ("pair.zh", "50", "en"), ("pair.en", "51", "de"),
        ("record_snapshot", "x1", "en-en"), ("record_snapshot", "x2", "en-zh"), ("record_snapshot", "x3", "other"),
    ])


def test_held_out_accuracy():
    labelled = [(c, s + f" {i}") for c, own in (("en", EN), ("de", DE), ("zh", ZH)) for s in own for i in range(3)] + [("de", s) for s in EN[:1]]
    model = L.Classifier.of(L.agreeing(labelled, L._WORD.findall))
    assert EN[0] not in model.dictionaries["de"].decode()
    for code, text in (("en", "the cat sat in the kitchen"), ("de", "die katze sass in der küche"), ("zh", "猫在厨房里坐在旧垫子上")):
        assert model.classify(text)[0] == code
    assert model.classify("zzz qqq")[0] is None and model.classify("")[0] is None


def test_labels_and_sentences():
    assert [L.code_of(x) for x in ("EN", "en-GB", "English", "zh-Hans", "jpn", "und", "", None, "??")] == ["en", "en", "en", "zh", "ja", None, None, None, None]
    text = "One. Two!\nThree。四。Das ist es"
    parts = list(L.sentences(text))
    assert "".join(text[a:b] for a, b in parts) == text and len(parts) == 5
    assert list(L.sentences("")) == []


def test_segments(spark):
    model = L.fit_languages(spark.createDataFrame(corpus(), DOCS), [])
    rows = L.document_segments(spark.createDataFrame([(1, EN[0] + ". " + DE[1] + ".", "en", 1), (2, None, "en", 1), (3, "", "en", 1)], DOCS), model).collect()
    assert [(r.doc_id, r.segment, r.lang) for r in rows] == [(1, 0, "en"), (1, 1, "de")] and all(0 < r.confidence <= 1 for r in rows)


def test_empty_tables(spark):
    assert L.found(spark.createDataFrame([], DOCS), spark.createDataFrame([], PAIRS), spark.createDataFrame([], SNAPS)).count() == 0


def test_languages_that_are_not_listed():
    """Scripts alone decide nothing: a text that no dictionary helps with has no language."""
    ru = "кошка сидела на старом коврике,когда идёт дождь дверь остаётся открытой,никто не знает почему лампа сломана".split(",")
    model = L.Classifier.of({"en": EN, "de": DE, "zh": ZH, "ru": ru})
    assert model.possible(L.plain("Київ є столицею України")) == ("ru",)
    for text in ("Київ є столицею України та найбільшим містом країни.", "한국의 수도는 서울이고 인구는 약 천만 명이다.", "東京大学法学部入学試験問題集改訂版", "이것은 한국어 문장입니다"):
        assert model.classify(L.plain(text))[0] is None
    assert model.classify(L.plain("никто не знает почему кошка сидела"))[0] == "ru" and model.classify(L.plain("没有人知道灯为什么坏了"))[0] == "zh"
    assert not L.scripts("한국어") and L.scripts("豈更")["han"] == 2


def test_long_text_without_ends():
    model = L.Classifier.of({"en": EN, "de": DE, "zh": ZH})
    text = "".join(ZH[i % 5] for i in range(400))
    assert [x[2] for x in L.segments(text, model)] == ["zh"]


def test_label_code(spark):
    from pyspark.sql import functions as F

    labels = ["EN", "en_GB", "English", "zh-Hans", "jpn", "und", "", None, "??", "German (old)"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in labels], "x string").select(L.label_code(F.col("x"))).collect()]
    assert got == [L.code_of(x) for x in labels]
