import random

import numpy as np

from lexlake.llm.leakage import WIDTH, Run, equal_words, item_block, leaks, reachable, runs, share_of

DOCS, ITEMS = "doc_id long, text string, item_id int, t int", "item_id long, text string, lang string"
WORDS = [a + b for a in "b d f g k l m n p r s t v z".split() for b in "ale ine oru ama eki upo".split()]


def brute(doc, item, first):
    """The best score of Smith-Waterman over the diagonals from first on, cell by cell."""
    n, best = len(item), 0
    h = [[0] * (n + 1) for _ in range(len(doc) + 1)]
    for i in range(1, len(doc) + 1):
        for j in range(1, n + 1):
            if first <= i - j < first + WIDTH:
                up = h[i - 1][j] - 2 if i - 1 - j >= first else 0
                left = h[i][j - 1] - 2 if i - j + 1 < first + WIDTH else 0
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if doc[i - 1] == item[j - 1] else -2), up, left)
                best = max(best, h[i][j])
    return best


def band(doc, item, first):
    d = np.append(doc, -1).astype(np.int32)
    return equal_words(d, np.array([0]), np.array([len(doc)]), np.array([first]), item.astype(np.int32)[None])


def test_alignment_score():
    r = random.Random(2)
    for _ in range(80):
        item = np.array([r.randrange(6) for _ in range(12)])
        doc = np.array([r.randrange(6) for _ in range(30)])
        first = r.randrange(-10, 20)
        best, same = brute(doc, item, first), band(doc, item, first)
        assert max((x.score for x in runs(same[0], 1)), default=0) == best
        assert not list(runs(same[0], best + 1))


def test_reachable_holds_runs():
    r = random.Random(5)
    some = 0
    for _ in range(80):
        item, doc = (np.array([r.randrange(5) for _ in range(n)]) for n in (r.randrange(4, 14), r.randrange(4, 40)))
        least, first = r.randrange(6, 16), r.randrange(-8, 20)
        same = band(doc, item, first)
        x = reachable(same, np.array([least]))[0]
        found = list(runs(same[0], least))
        assert not any((f.holds & ~x).any() for f in found)
        assert x.any() == bool(found) == (brute(doc, item, first) >= least)
        some += x.any()
    assert 0 < some < 80


def test_share():
    def run(score, at, *places):
        return Run(score, at, np.isin(np.arange(40), places))

    near = [run(10, 5000, *range(10)), run(10, 5100, *range(10, 20))]
    far = [run(10, 500, *range(10)), run(10, 90_000, *range(10, 20))]
    assert share_of(near, 40, 100_000, 10) == 0.5 and share_of(far, 40, 100_000, 10) == 0.25 and share_of(far, 40, 256, 10) == 0.5
    assert share_of([run(40, 500, *range(20)), run(40, 90_000, *range(20, 40))], 40, 100_000, 10) == 1.0 and share_of([], 40, 10, 10) == 0


def test_short_items_in_long_documents(spark):
    """A copy word for word is found in a document of any length; items without seeds stand whole or not at all."""
    r = random.Random(3)
    items = [(1, text(r, 8), "en"), (2, text(r, 10), "en"), (3, text(r, 3), "en"), (4, "天地玄黄", "zh"), (5, text(r, 1), "en"), (6, "...", "en"), (7, text(r, 6), "en")]
    docs = [(n, " ".join([text(r, n), *(t for _, t, _ in items[:4]), text(r, n)]), 1, 1) for n in (50, 4_000, 100_000)]
    own = items[2][1].split()
    docs += [(1, " ".join([own[0], own[1], "zzz", own[2]]), 1, 1), (2, "天地x玄黄", 1, 1), (3, "zzz " + " ".join(items[6][1].split()[:2]), 1, 1)]
    got = {tuple(x) for x in leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([i for i in items if i[0] != 5], ITEMS)).select("doc_id", "item_id").collect()}
    assert got == {(n, i) for n in (50, 4_000, 100_000) for i in (1, 2, 3, 4)}
    assert item_block([(5, items[4][1])]).seeds and not item_block([(6, "...")]).seeds


def test_one_document_with_many_copies(spark):
    r = random.Random(4)
    item = text(r, 30)
    docs = [(1, " ".join(item + " " + text(r, 5) for _ in range(300)), 1, 1)]
    assert leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, item, "en")], ITEMS)).first()["held"] == 1.0


def text(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def test_leaks(spark):
    r = random.Random(7)
    items = [(i, text(r, 60), "en") for i in range(20)] + [(100, "".join(r.choice("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往") for _ in range(60)), "zh")]
    own = {i: t.split() for i, t, _ in items}
    half = " ".join(own[2][20:60])
    changed = [w if k % 7 else "xxxx" for k, w in enumerate(own[3])]
    docs = [
        (1, text(r, 100) + " " + items[0][1] + " " + text(r, 50), 1, 1), (2, items[1][1].upper().replace(" ", ",  "), 1, 1), (3, text(r, 30) + " " + half + text(r, 30), 1, 1),
        (4, " ".join(changed), 1, 1), (5, " ".join(own[4][30:] + text(r, 20).split() + own[4][:30]), 1, 1), (6, " ".join(own[5][:20]) + text(r, 200), 1, 1), (7, items[6][1].replace("a", "а").replace("e", "​e"), 1, 1),
        (8, "前言" + items[20][1][:40] + "后记", 1, 1), (9, None, 1, 1), (10, "", 1, 1), (11, text(r, 30_000), 1, 1), (12, items[0][1] + " " + items[1][1], 1, 1), (12, items[0][1] + " " + items[1][1], 1, 1),
    ]
    docs += [(1000 + i, text(r, 80) if i % 3 else items[7][1], 1, 1) for i in range(300)]
    got = {tuple(x) for x in leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items + items[:2] + [(50, None, "en"), (51, "", "en")], ITEMS)).select("doc_id", "item_id").collect()}
    want = {(1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (7, 6), (8, 100), (12, 0), (12, 1)} | {(1000 + i, 7) for i in range(0, 300, 3)}
    assert got == want


def test_half_in_many_documents(spark):
    """Three runs of 12 words of 60 hold 24 of 56 seeds: more than half of the seeds stand nowhere."""
    r = random.Random(11)
    items = [(i, text(r, 60), "en") for i in range(3)]
    w = items[0][1].split()
    docs = [(k, " ".join([*w[24:36], text(r, 20), *w[:12], text(r, 20), *w[48:60]]) if k % 3 == 0 else text(r, 80), 1, 1) for k in range(90)]
    got = {tuple(x) for x in leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).select("doc_id", "item_id").collect()}
    assert got == {(k, 0) for k in range(0, 90, 3)}


def test_empty(spark):
    d, i = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    full = spark.createDataFrame([(1, "a b c d e f g", "en")], ITEMS)
    assert leaks(d, i).count() == leaks(d, full).count() == leaks(spark.createDataFrame([(1, "x y", 1, 1)], DOCS), i).count() == 0
