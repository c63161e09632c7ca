import random

import pytest
from pyspark.sql import functions as F

from lexlake.operators import analyzer, corpus, graph, inventories, keys, layers, lookup, once, quality, sampling, search


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_components_against_union_find(spark):
    r = random.Random(4)
    edges = [(f"n{r.randrange(300):03}", f"n{r.randrange(300):03}") for _ in range(200)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(90)] + [("hub", f"s{i:03}") for i in range(80)] + [("z", "z"), ("z", None)]
    parent = {x: x for e in edges for x in e if x}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a and b and find(a) != find(b):
            lo, hi = sorted((find(a), find(b)))
            parent[hi] = lo
    got = rows(graph.components(spark.createDataFrame(edges, "a string, b string"), "a", "b"))
    assert got == sorted((x, find(x)) for x in parent)
    assert graph.components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_closure_with_cycles(spark):
    e = spark.createDataFrame([(1, "took", "take"), (1, "a", "b"), (1, "b", "c"), (1, "c", "d"), (1, "d", "e"), (1, "e", "f"), (1, "f", "end"), (1, "l1", "l2"), (1, "l2", "l1"), (1, "x", "end"), (1, "x", "y"), (1, "y", "end"), (2, "took", "end")], "dict_id long, source string, target string")
    ends = spark.createDataFrame([(1, "take"), (1, "end")], "dict_id long, target string")
    got = rows(graph.redirect_closure(e, ends))
    assert (1, "took", "take", 1) in got and (1, "x", "end", 1) in got and (1, "b", "end", 5) in got and not [r for r in got if r[1] in ("a", "l1") or r[0] == 2]


def test_digests_change_with_content_and_order(spark):
    data = [(1, i, f"w{i}", None if i % 3 else "x") for i in range(50)] + [(2, 0, "a", "")]

    def run(d, block=7):
        return dict((r[0], r[1:]) for r in rows(keys.ordered_digests(spark.createDataFrame(d, "g long, i long, a string, b string"), "g", ["i"], ["a", "b"], block)))

    base = run(data)
    assert run(data[::-1]) == base and base[1][0] == 50
    assert run([(1, 49 - i, *x[2:]) for i, x in enumerate(data[:50])] + data[50:])[1] != base[1]
    assert run(data[:50] + [(2, 0, "", "a")])[2] != base[2] and run([]) == {}
    assert keys.streamed_digest([["a", "bc"]]) != keys.streamed_digest([["ab", "c"]])


def test_popups_follow(spark):
    entries = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    senses = spark.createDataFrame([(10, 1, 0), (11, 1, 1), (20, 2, 0), (30, 3, 0), (31, 3, 1)], "id long, entry_id long, ord int")
    got = rows(keys.fold_popups(entries, senses, spark.createDataFrame([(3, 1), (2, 1)], "popup_id long, main_id long")))
    assert got == [(1, 0, 10), (1, 1, 11), (1, 2, 20), (1, 3, 30), (1, 4, 31)]


def test_once_and_samples(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", None), (2, "c", 5)], "id long, v string, at long")
    assert rows(once.once(df, "id", "at")) == [(1, "a", 1), (2, "c", 5)]
    big = spark.range(200).select("id", (F.col("id") % 3).alias("g"))
    one, two = sampling.seeded(big, "g", "id", 4, "s"), sampling.seeded(big.repartition(7), "g", "id", 4, "s")
    assert rows(one) == rows(two) and one.count() == 12 and rows(one) != rows(sampling.seeded(big, "g", "id", 4, "t"))
    assert sampling.spread(big, "g", "id", 5).count() == 15 and sampling.spread(big, "g", "id", 500).count() == 200
    assert sampling.weighted(big.withColumn("w", (F.col("id") % 2).cast("double")), "id", "w", 20, "s").where("id % 2 = 0").count() == 0


def test_verdicts(spark):
    pairs = [(1, "The cat sat on the mat.", "猫坐在垫子上。"), (2, "Das ist der Hund und die Katze.", "这是狗和猫。"), (3, "cat", "猫"), (4, "the black cat", "猫です黒い"), (5, "the black cat", ""), (6, "猫 the cat", "黑猫"), (7, "see sb off here", "送某人"), (8, "a ~ of cats", "一群猫"), (9, "the <b>cat</b>", "黑猫"), (10, "a cat", "猫" * 30), (11, None, "猫"), (12, "the black cat", "【语法】"), (13, "the cat", "cat"), (14, "a cat \x07 here", "这里有猫"), (15, "cat /kæˈtə/ here", "这里有猫"), (16, "12 34", "数字")]
    got = {r.id: (r.ok, r.kind, r.reason) for r in corpus.verdicts(spark.createDataFrame(pairs, "id long, en string, zh string")).collect()}
    assert got[1] == (True, "sentence", "") and [got[i][2] for i in range(2, 17)] == [
        "the Latin-script side is not English", "a single word, not an example", "Japanese or Korean on the Chinese side", "empty side", "Chinese on the English side", "a template with placeholders", "a placeholder for the headword",
        "markup in text", "length ratio implausible for a translation", "empty side", "a label, not a translation", "no Chinese on the Chinese side", "garbled text", "pronunciation in text", "no English words",
    ]


def test_corpus_measures(spark):
    lex = spark.createDataFrame([("cat", "黑猫"), ("cat", "小猫"), ("mat", "垫子"), ("dog", "小狗")], "word string, gram string")
    got = rows(corpus.alignment(spark.createDataFrame([(1, "the Cat, the mat", "黑猫和狗"), (2, "nothing", "无")], "id long, en string, zh string"), lex))
    assert got == [(1, 2, 1)]
    p = rows(corpus.precision(spark.createDataFrame([("a", True, False), ("a", False, True), ("a", False, False), ("a", False, False)], "source string, bad boolean, pending boolean")))
    assert p == [("a", 4, 1, 1, 0.5)]
    assert [corpus._kept([5, 5], 15), corpus._kept([10, 5], 8), corpus._kept([5], 0)] == [2, 1, 1]
    d = spark.createDataFrame([(1, 0.96), (2, 0.9), (3, None)], "id long, precision double")
    assert [r[1] for r in rows(corpus.admitted(d))] == [True, False, False] and [r[1] for r in rows(corpus.admitted(d, unaudited=True))] == [True, False, True]


def test_search(spark):
    words = spark.createDataFrame([("serendipity",), ("serene",), ("box",), ("ab",), ("abc",), ("",), (None,)], "word string")
    q = spark.createDataFrame([("serendipty",), ("bx",), ("a",)], "query string")
    got = rows(search.similar(search.gram_index(words, "word"), q))
    assert [(r[0], r[1], r[3]) for r in got] == [("serendipty", "serendipity", 1)]
    short = rows(search.short_suggestions(words, q))
    assert ("bx", "box", 1) in short and ("a", "ab", 1) in short and ("a", "abc", 2) in short
    terms = spark.createDataFrame([("一个水壶",), ("水壶",), ("壶",), (None,)], "term string")
    got = rows(search.containing(terms, spark.createDataFrame([("水壶",), ("一个水",), ("",)], "query string")))
    assert got == [("一个水", "一个水壶"), ("水壶", "一个水壶"), ("水壶", "水壶")]
    phrases = spark.createDataFrame([("take off",), ("in the long run now",), ("word",), ("never seen",), (None,)], "phrase string")
    docs = spark.createDataFrame([("They take off in the long run.",), ("the long run now",), (None,)], "body string")
    assert rows(search.attested(phrases, docs, "phrase", "body")) == [("in the long run now", 2, 2, True), ("never seen", 1, 0, False), ("take off", 1, 1, True), ("word", 0, 0, None)]


def test_lookup_falls_back_to_redirects(spark):
    e = spark.createDataFrame([(1, 1, "take"), (2, 1, "take"), (3, 2, "took")], "entry_id long, dict_id long, norm string")
    c = spark.createDataFrame([(1, "took", "take", 1), (2, "took", "x", 1)], "dict_id long, source string, target string, hops int")
    assert rows(lookup.direct_or_redirected(spark.createDataFrame([("took",)], "query string"), e, c)) == [("took", 1, 1, 1), ("took", 1, 2, 1), ("took", 2, 3, 0)]


def test_phrase_groups_against_sequence(spark):
    r = random.Random(9)
    records = [(i, r.randrange(4), [f"k{r.randrange(60)}" for _ in range(r.randrange(1, 4))]) for i in range(120)]
    want = sorted(inventories.anchored((i, k) for i, p, k in sorted(records, key=lambda x: (x[1], x[0]))), key=repr)
    schema = "record_id long, preference int, keys array<string>"
    assert rows(inventories.phrase_groups(spark.createDataFrame(records, schema))) == want
    single = [(i, p, k[:1]) for i, p, k in records]
    want = sorted(inventories.anchored((i, k) for i, p, k in sorted(single, key=lambda x: (x[1], x[0]))), key=repr)
    assert rows(inventories.phrase_groups(spark.createDataFrame([*single, (900, 1, []), (901, 1, None)], schema))) == want


def test_keys_of_phrases(spark):
    df = spark.createDataFrame([(["put", "{sb/sth}", "on", "{one's}", "feet"],), ([],), (None,)], "t array<string>")
    got = [tuple(r) for r in df.select(inventories.phrase_key(F.col("t")), inventories.collocation_key(F.col("t"))).collect()]
    assert got[0] == ("put {obj} on {poss} feet", "put {obj} on feet") and got[1][0] == "" and got[2][0] is None


def test_order_votes(spark):
    df = spark.createDataFrame([("a", "x", "left")] * 3 + [("a", "y", "left"), ("a", "z", "right"), ("b", "x", "right"), ("b", "y", "right")], "item string, gap string, side string")
    assert rows(inventories.order_votes(df)) == [("a", "left", "x"), ("b", "right", None)]


def tok(sent, i, word, pos, tag, dep, head, lemma=None):
    return (sent, i, word, pos, tag, dep, head, sorted({word, lemma or word}), pos == "PUNCT")


TOKENS = "sent_id long, i int, lower string, pos string, tag string, dep string, head int, lemmas array<string>, punct boolean"
SENT = [
    tok(1, 0, "she", "PRON", "PRP", "nsubj", 1), tok(1, 1, "put", "VERB", "VBD", "ROOT", 1), tok(1, 2, "the", "DET", "DT", "det", 3), tok(1, 3, "meeting", "NOUN", "NN", "dobj", 1), tok(1, 4, "off", "ADP", "RP", "prt", 1), tok(1, 5, ".", "PUNCT", ".", "punct", 1),
    tok(2, 0, "a", "DET", "DT", "det", 2), tok(2, 1, "hard", "ADJ", "JJ", "amod", 2), tok(2, 2, "decision", "NOUN", "NN", "nsubjpass", 4), tok(2, 3, "was", "AUX", "VBD", "auxpass", 4, "be"), tok(2, 4, "made", "VERB", "VBN", "ROOT", 4, "make"),
    tok(3, 0, "in", "ADP", "IN", "ROOT", 0), tok(3, 1, "the", "DET", "DT", "det", 3), tok(3, 2, "main", "ADJ", "JJ", "amod", 3), tok(3, 3, "room", "NOUN", "NN", "pobj", 0),
]


def test_patterns_and_relations(spark):
    tokens = spark.createDataFrame(SENT, TOKENS)
    patterns = spark.createDataFrame([(1, ["put", "{obj}", "off"]), (2, ["in", "the", "main"]), (3, ["put", "off"]), (4, ["the", "{obj}", "off"])], "item_id long, tokens array<string>")
    got = rows(analyzer.match_patterns(tokens, analyzer.anchors(patterns)))
    assert got == [(1, 1, 1, 4, [1, 4], 2), (1, 4, 2, 4, [2, 4], 1)]
    items = spark.createDataFrame([(7, "decision", "make", "verb_obj"), (8, "decision", "hard", "adj_noun"), (9, "room", "make", "verb_obj")], "item_id long, base string, coll string, relation string")
    assert rows(analyzer.match_relations(tokens, items)) == [(2, 7, 2, 4), (2, 8, 2, 1)]
    assert analyzer.match_patterns(tokens.limit(0), analyzer.anchors(patterns)).count() == 0


def test_trim_lemmas_confidence(spark):
    df = spark.createDataFrame([(["{...}", "a", "{obj}", "{...}"],), (["{...}"],)], "t array<string>")
    assert [r[0] for r in df.select(analyzer.trimmed(F.col("t"))).collect()] == [["a", "{obj}"], []]
    forms = spark.createDataFrame([("saw", "see", "VERB", 9), ("saw", "saw", "NOUN", 3), ("saw", "sew", "VERB", 1)], "form string, lemma string, upos string, n int")
    t = spark.createDataFrame([(1, 0, "saw", "NOUN"), (1, 1, "saw", "VERB"), (1, 2, "xyz", "NOUN")], "sent_id long, i int, lower string, pos string")
    assert [r[2] for r in rows(analyzer.chosen_lemmas(t, forms))] == ["saw", "see", "xyz"]
    c = spark.createDataFrame([("collocation", "", 0, 1, False), ("phrase", "phrasal_verb", 1, 2, True), ("phrase", "phrasal_verb", 1, 2, False), ("phrase", "idiom", 1, 3, False), ("phrase", "idiom", 1, 2, False)], "s string, k string, c int, w int, p boolean")
    assert [r[0] for r in c.select(analyzer.confidence(F.col("s"), F.col("k"), F.col("c"), F.col("w"), F.col("p"))).collect()] == ["likely", "likely", "possible", "likely", "possible"]


def test_resolution_equals_greedy(spark):
    r = random.Random(6)
    ms = [(i, r.randrange(4), "phrase" if r.random() < 0.8 else "collocation", sorted(r.sample(range(6), r.randrange(1, 4))), r.randrange(2), r.randrange(3), 1, i % 7) for i in range(60)]
    kept = []
    for m in sorted(ms, key=lambda m: (-len(m[3]), m[4], -m[5], -m[6], m[7], m[0])):
        if m[2] == "collocation" or not any(k[1] == m[1] and k[2] == "phrase" and set(m[3]) <= set(k[3]) for k in kept):
            kept.append(m)
    df = spark.createDataFrame(ms, "match_id long, sent_id long, source string, literals array<int>, n_slots int, n int, publishers int, item_id long")
    assert rows(analyzer.resolve(df).select("match_id")) == sorted([(m[0],) for m in kept], key=repr)


def test_layers(spark):
    good = '<div><span class="hw">Take</span><span class="pos">verb</span><span class="uk">/teɪk/</span><span class="def">to get</span><span class="zh">拿</span><span class="ex">take it</span><span class="zh">拿走</span></div>'
    df = spark.createDataFrame([(1, 1, "take", good), (2, 1, "see", '<span class="see">take</span>'), (3, 1, None, None), (4, 2, "x", "<p>y</p>"), (5, 3, "z", "<p>y</p>")], "id long, dict_id long, headword string, body string")
    parsed = layers.parse_entries(df, F.when(F.col("dict_id") == 1, "bilingual").when(F.col("dict_id") == 2, "origins").otherwise("none"))
    got = {r.entry_id: r for r in parsed.collect()}
    assert got[1].problems == [] and got[1].entry.senses[0].examples[0].text_zh == "拿走" and got[1].entry.prons[0].ipa == "teɪk"
    assert got[3].problems == ["empty headword"] and got[5].entry is None and "KeyError" in got[5].problems[0]
    t = layers.tables(parsed)
    assert t["s_sense"].count() == 1 and t["s_example"].count() == 1 and t["s_pron"].count() == 1 and t["s_entry"].count() == 3
    report = layers.coverage(parsed, "definitions")
    assert rows(report) == [(1, 3, 1, 1, 1), (2, 1, 0, 0, 0), (3, 1, 0, 0, 1)]
    assert [r.dict_id for r in layers.failures(report, 0.99).orderBy("dict_id").collect()] == [1, 2, 3]
    bad = layers.filled(layers.ENTRY, {"headword": " <b>x</b>", "stub": "odd", "part_of": "y", "senses": [{"kind": "phrase"}, {"kind": "odd", "examples": [{"kind": "odd"}]}], "prons": [{"region": "zz"}]})
    assert len(layers.problems(bad)) == 11
    with pytest.raises(ValueError):
        layers.parser("plain", "definitions")(lambda h, m: {})
    with pytest.raises(ValueError):
        layers.parser("new", "everything")


def test_failing_invariants(spark, small):
    from lexlake.plans.inventory_queries import invariants

    found = invariants(spark, small)
    assert quality.failing(found).count() <= found.count() == len(quality.ROW_CHECKS) + len(quality.LINK_CHECKS) + len(quality.KEY_CHECKS)
