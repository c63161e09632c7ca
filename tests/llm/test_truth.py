import random
from collections import Counter

import numpy as np

from lexlake.llm.truth import Sources, dependence, fused, vote

PAIRS = "cluster long, dictionary_id long, zh_hans string, kind string, headword string, p int, sources int"


def data():
    """Sources 1, 2, 7, 8 and 9 err by themselves; 3 errs on a third, and 4, 5 and 6 copy it."""
    rows = []
    for c in range(90):
        for i, s in enumerate((1, 2, 7, 8, 9)):
            rows.append((c, s, f"e{s}-{c}" if (c + 3 * i) % 11 == 0 else f"r{c}", "k", None, 1, 1))
        rows += [(c, s, f"w{c}" if c % 3 == 0 else f"r{c}", "k", "-" if s == 3 else "", 1, 1) for s in (3, 4, 5, 6)]
    return rows


def test_copied_votes_count_for_little(spark):
    d = spark.createDataFrame([(i, None) for i in range(1, 10)], "id long, precision double")
    got = {(r.cluster, r.field): r for r in fused(spark.createDataFrame(data(), PAIRS), d).collect()}
    votes = [Counter(r[2] for r in data() if r[0] == c).most_common(2) for c in range(90)]
    undecided = [c for c, v in enumerate(votes) if len(v) > 1 and v[0][1] == v[1][1]]
    assert len(undecided) > 10 and all(got[c, "zh_hans"].value == f"r{c}" for c in range(90))
    assert all(got[c, "kind"].posterior > 0.9 for c in range(90)) and not [k for k in got if k[1] == "headword"]


def test_spread_groups_give_the_same(spark):
    d = spark.createDataFrame([(i, None) for i in range(1, 10)], "id long, precision double")
    df = spark.createDataFrame(data() + [(0, 1 + i % 9, f"v{i % 40}", "k", "h", 1, 1) for i in range(300)], PAIRS)
    one, many = (sorted(map(tuple, fused(df, d, hot_records=n).collect())) for n in (10**6, 50))
    assert one == many and len(one) > 180


def test_dependence_and_votes():
    a = np.array([0.8, 0.8, 0.8])
    pairs = np.array([1, 2])  # 0 with 1, 0 with 2
    dep = dependence(np.array([10, 0]), np.array([3, 3]), a[[0, 0]], a[[1, 2]])
    known = Sources(a, pairs, np.array([13, 3]), dep)
    assert dep[0] > 0.9 > 0.1 > dep[1] and known.of(np.array([1, 2]), np.array([0, 1])).tolist() == [dep[0], 0.0]
    assert vote(np.array([0, 1]), known) < vote(np.array([0, 2]), known)


def test_accuracy_on_planted_truth(spark):
    """20 independent sources of different accuracy and a clique of 6 copiers of a bad one: fusion beats the majority."""
    r, rows, truth = random.Random(9), [], {}
    good = [0.55 + 0.4 * i / 19 for i in range(20)]
    for c in range(1500):
        truth[c] = f"t{c}"
        bad = truth[c] if r.random() < 0.4 else f"w{c}-{r.randrange(9)}"
        said = [(s, truth[c] if r.random() < good[s] else f"w{c}-{r.randrange(9)}") for s in r.sample(range(20), 5)]
        said += [(s, bad) for s in range(20, 26) if r.random() < 0.8]
        rows += [(c, s + 1, v, None, None, 1, 1) for s, v in said]
    d = spark.createDataFrame([(i + 1, None) for i in range(26)], "id long, precision double")
    got = {x.cluster: x.value for x in fused(spark.createDataFrame(rows, PAIRS), d).collect()}
    votes = {c: Counter() for c in truth}
    for c, _, v, *_ in rows:
        votes[c][v] += 1
    fusion = sum(got[c] == truth[c] for c in truth) / len(truth)
    majority = sum(votes[c].most_common(1)[0][0] == truth[c] for c in truth) / len(truth)
    print(fusion, majority)
    assert fusion > 0.93 and majority < 0.75


def test_odd_rows(spark):
    d = spark.createDataFrame([(1, 0.9)], "id long, precision double")
    rows = [(1, None, "a", None, "?", 1, 1), (1, 99, "a", "N/A", None, 1, 1), (None, 1, "a", "k", "h", 1, 1), (2, 1, "b", "k", "h", 1, 1), (2, 1, "b", "k", "h", 1, 1)]
    got = sorted((r.cluster, r.field, r.value, r.sources) for r in fused(spark.createDataFrame(rows, PAIRS), d).collect())
    assert got == [(1, "zh_hans", "a", 1), (2, "headword", "h", 1), (2, "kind", "k", 1), (2, "zh_hans", "b", 1)]
    assert fused(spark.createDataFrame([], PAIRS), d).count() == 0
    assert fused(spark.createDataFrame(rows, PAIRS), d.limit(0)).count() == 4
