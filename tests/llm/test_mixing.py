import random

import pytest
from pyspark.sql import functions as F

from lexlake.llm.mixing import Leaf, budget, mixture, report

DOCS = "doc_id long, text string, source string, leaf int, h int"
TARGETS = "source string, target_share double, max_repeats int"


def test_shortage_goes_to_siblings_first():
    leaves = [Leaf(("a", "x"), 0.25, 10, 1), Leaf(("a", "y"), 0.25, 1000, 1), Leaf(("b", "z"), 0.5, 1000, 1)]
    assert budget(leaves, 200) == 0
    assert [round(x.quota) for x in leaves] == [10, 90, 100]
    leaves = [Leaf(("a", "x"), 0.25, 10, 1), Leaf(("a", "y"), 0.25, 20, 1), Leaf(("b", "z"), 0.5, 1000, 1)]
    assert budget(leaves, 200) == 0 and [round(x.quota) for x in leaves] == [10, 20, 170]
    leaves = [Leaf(("a",), 1.0, 10, 2), Leaf(("b",), 0.0, 10, 2)]
    assert budget(leaves, 100) == 80 and [x.quota for x in leaves] == [20, 0]
    assert budget([], 5) == 5
    leaves = [Leaf(("a", "x"), 1.0, 10), Leaf(("a", "y"), 0.0, 1000), Leaf(("b", "z"), 1.0, 10_000)]
    assert budget(leaves, 1000) == 0 and [x.quota for x in leaves] == [10, 0, 990]
    assert budget(leaves, 20_000) == 20_000 - 10_010 and [x.quota for x in leaves] == [10, 0, 10_000]


def test_budget_places_all_that_there_is_room_for():
    r = random.Random(1)
    for _ in range(200):
        paths = {tuple(r.choice("abc") for _ in range(3)) for _ in range(r.randrange(1, 12))}
        leaves = [Leaf(p, r.choice([0.0, 0.1, 1.0, 3.0]), r.randrange(0, 50), r.randrange(1, 4)) for p in sorted(paths)]
        room, total = sum(x.most for x in leaves if x.weight > 0), r.randrange(0, 400)
        assert budget(leaves, total) == pytest.approx(max(0, total - room))
        assert sum(x.quota for x in leaves) == pytest.approx(min(total, room)) and all(x.quota <= x.most + 1e-9 for x in leaves)


def docs(spark, n=400):
    rows = [(i, f"text number {i} " + "word " * (i % 30), "abc"[i % 3], 1, 1) for i in range(n)]
    rows += [(9000, "the same text", "a", 1, 1), (9001, "the same text", "a", 1, 1), (9002, None, "a", 1, 1), (9003, "", "a", 1, 1), (9004, "x y", None, 1, 1), (9005, "long " * 3000, "a", 1, 1), (9006, "p q", "unlisted", 1, 1)]
    return spark.createDataFrame(rows, DOCS)


def test_shares_and_repeats(spark):
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.5, 3), ("c", 0.3, 1)], TARGETS)
    sample, leaves = mixture(docs(spark), targets, total=6000, ranges=16)
    rows = {r.source: r for r in report(sample, leaves).collect()}
    assert {s: r.most_copies <= r.max_repeats for s, r in rows.items()} == dict.fromkeys("abc", True)
    for s, share in (("a", 0.2), ("b", 0.5), ("c", 0.3)):
        assert rows[s].actual_share == pytest.approx(share, abs=0.03) or rows[s].shortfall_tokens > 0
    again, _ = mixture(docs(spark).repartition(7), targets, total=6000, ranges=64)
    assert sorted(map(str, sample.collect())) == sorted(map(str, again.collect()))
    ids = [r.doc_id for r in sample.collect()]
    assert len(ids) == len(set(ids)) and not {9001, 9002, 9003, 9004, 9006} & set(ids)


def test_shortfall_is_shown(spark):
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1), ("none", 0.5, 2)], TARGETS)
    sample, leaves = mixture(docs(spark), targets, total=10**6)
    rows = {r.source: r for r in report(sample, leaves).collect()}
    assert leaves.total == 10**6 and leaves.unplaced > 0 and sum(r.wanted_tokens for r in rows.values()) == pytest.approx(10**6, abs=3)
    assert rows["b"].tokens == rows["b"].available_tokens and rows["b"].shortfall_tokens > 0 and rows["none"].tokens == 0
    assert sum(r.actual_share for r in rows.values()) == pytest.approx(1)


def test_empty(spark):
    t = spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    for d, x in ((docs(spark).limit(0), t), (docs(spark), t.limit(0))):
        sample, leaves = mixture(d, x)
        assert sample.count() == 0 and report(sample, leaves).count() == len(leaves.leaves)


def test_oversized_texts_are_passed_over(spark):
    """However many texts are too long for what is left, shorter ones after them are drawn."""
    d = spark.createDataFrame([(i, "word " * 900 + str(i), "a", 1, 1) for i in range(40)] + [(100 + i, f"short {i}", "a", 1, 1) for i in range(30)], DOCS)
    sample, _ = mixture(d, spark.createDataFrame([("a", 1.0, 1)], TARGETS), total=1000, ranges=16)
    got = sample.collect()
    assert sum(r.doc_id >= 100 for r in got) == 30 and sum(r.n_tokens for r in got) <= 1000


def test_tree(spark):
    d = docs(spark).withColumn("domain", F.when(F.col("source") == "c", "z").otherwise("y"))
    t = spark.createDataFrame([("y", "a", 1.0, 1), ("y", "b", 1.0, 1), ("z", "c", 2.0, 1)], "domain string, source string, target_share double, max_repeats int")
    sample, plan = mixture(d, t, path=("domain", "source"), total=4000)
    quotas = {x.path: round(x.quota) for x in plan.leaves}
    assert quotas[("z", "c")] == 2000 or quotas[("z", "c")] == next(x.most for x in plan.leaves if x.path == ("z", "c"))
    assert {(r.domain, r.source) for r in report(sample, plan, ("domain", "source")).collect()} == set(quotas)
