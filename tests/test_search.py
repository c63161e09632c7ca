import math
import random
import re
from collections import Counter
from difflib import SequenceMatcher

from lexlake.functions.stem import stems
from lexlake.operators import lookup, search
from lexlake.plans import search_queries


def test_similar_has_no_cut(spark):
    """Words longer than the query that share more trigrams with it don't push the like ones out."""
    query = "abcdefghijklmnop"
    crowd = [(f"abcdefghijkl{i:03d}{'x' * 10}",) for i in range(500)]
    like = [("abcdeXfghijXklmnop",), ("abcXdefXghiXjklXmnop",)]
    words = spark.createDataFrame(crowd + like + [("abx",), ("unlike",)], "word string")
    got = {(r.query, r.word, r["rank"]): r.ratio for r in search.similar(search.gram_index(words, "word"), spark.createDataFrame([(query,), (None,)], "query string")).collect()}
    every = sorted(((-SequenceMatcher(None, query, w).ratio(), w) for (w,) in crowd + like if SequenceMatcher(None, query, w).ratio() >= search.SIMILAR))
    assert every and got == {(query, w, i + 1): -r for i, (r, w) in enumerate(every[: search.SUGGESTIONS])}


def test_gloss_queries_of_any_length(spark):
    """Every query against every term by brute force, without a join that holds all against all."""
    r = random.Random(3)
    terms = [(i, "".join(r.choice("天地玄黄") for _ in range(r.randrange(0, 7)))) for i in range(150)] + [(500, None)]
    asked = [(i, "".join(r.choice("天地玄黄") for _ in range(r.randrange(0, 5)))) for i in range(60)] + [(90, None)]
    t = spark.createDataFrame(terms, "sense_id long, term string")
    q = spark.createDataFrame(asked, "query_id long, query string")
    senses = t.selectExpr("sense_id", "sense_id AS entry_id", "sense_id % 3 AS dict_id")
    entries = t.selectExpr("sense_id AS entry_id", "concat('w', sense_id) AS headword")
    found = lookup.by_gloss(q, t, senses, entries, answers=1000)
    held = search.containing(t, q)
    pairs = [(i, x, s, y) for i, x in asked if x is not None for s, y in terms if y is not None and x in y]
    assert {(a["query_id"], a["word"], a["exact"]) for a in found.collect()} == {(i, f"w{s}", int(x == y)) for i, x, s, y in pairs}
    assert sorted(map(tuple, held.collect())) == sorted({(x, y) for _, x, _, y in pairs if x})
    for plan in (found, held):
        shown = plan._jdf.queryExecution().optimizedPlan().toString() + plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in shown and "Cartesian" not in shown


def test_define_sends_no_index_to_the_driver(spark, tmp_path):
    """A small table of long texts has an index larger than a broadcast may be; all rows come out right."""
    r = random.Random(5)
    letters = "bcdfgklmnprst"
    vocabulary = [a + o + b + p + c for a in letters for o in "aeiou" for b in letters for p in "aeiou" for c in letters][::3]
    few = ["walking", "harbour", "lanterns", "gardens"]  # frequent, and the only words of some queries
    texts = [(i, " ".join([*r.sample(few, 2), *r.sample(vocabulary, 50)])) for i in range(1, 4001)] + [(4100, None), (4200, "..."), (4300, "unheard of"), (4400, "walking walks walked to harbours")]
    spark.createDataFrame(texts, "id long, definition string").repartition(2).write.parquet(str(tmp_path / "s_sense.parquet"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", "12m")
    try:
        got = {(x.query_id, x.doc_id, x["rank"]): x.score for x in search_queries.define_stems(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    held = {i: Counter(stems(d)) for i, d in texts if d and stems(d)}
    mean, df = sum(c.total() for c in held.values()) / len(held), Counter(t for c in held.values() for t in c)
    want = {}
    for q, d in texts:
        if q % 100 == 0 and d and (terms := {s for w in re.findall("[a-z]{5,}", d)[:2] for s in stems(w)}):
            score = {i: round(sum(math.log(1 + (len(held) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * c.total() / mean)) for t in terms), 6) for i, c in held.items() if terms <= set(c)}
            want |= {(q, i, n + 1): score[i] for n, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[: search.DEFINED])}
    assert got.keys() == want.keys() and len(want) > 1000 and all(abs(got[x] - want[x]) < 2e-6 for x in want)
