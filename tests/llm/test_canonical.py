from collections import Counter

import pytest

from lexlake.llm.canonical import MISS, deletions, dictionaries, distance, mapped, reference, typed_values

ITEMS = [(1, "register", "informal", ["familiar style", "colloquial"]), (2, "register", "formal", []), (3, "region", "British", ["BrE"]), (4, "pos", "noun", ["n", "名词"]), (5, "time", "archaic", []), (6, "domain", "architecture", [])]


def find(value, scope="*", frequency=None):
    d = dictionaries(ITEMS, frequency or Counter())
    return d[scope].find(value)[3]


@pytest.mark.parametrize(
    "value, item",
    [("Informal", 1), ("infromal", 1), ("(colloquial)", 1), ("ｉｎｆｏｒｍａｌ", 1), ("chiefly informal:", 1), ("esp. familiar  style", 1), ("familiars tyle", 1), ("info.", 1), ("somewhat  often formal", 2), ("BRE.", 3), ("noun", MISS), ("xx", MISS), ("?", MISS), ("of weather", MISS), ("archa.", 5), ("archi.", 6)],
)
def test_values(value, item):
    assert find(value) == item


def test_pos():
    assert find("名词,", "pos") == 4 and find("N", "pos") == 4 and find("noum", "pos") == 4 and find("informal", "pos") == MISS


def test_ties_go_to_the_more_frequent():
    assert find("nformal", frequency=Counter({1: 9, 2: 1})) == 1
    assert find("nformal", frequency=Counter({1: 1, 2: 9})) == 2


def test_distance():
    assert distance("ab", "ba")[0] == 1 and distance("abc", "abc") == (0, 0.0) and distance("", "abc")[0] == 3
    assert distance("foemal", "formal")[1] < distance("fozmal", "formal")[1]
    assert deletions("abc", 1) == {"abc", "ab", "ac", "bc"}


def test_symmetric_delete_finds_what_brute_force_finds():
    import itertools
    import random

    r = random.Random(1)
    d = dictionaries(ITEMS, Counter())["*"]
    forms = [f for f, _, _ in d.forms if len(f) >= 6]
    for _ in range(300):
        w = list(r.choice(forms))
        for _ in range(2):
            i = r.randrange(len(w))
            if r.random() < 0.5:
                w[i] = r.choice("abcxyz")
            else:
                del w[i]
        key = "".join(w)
        near = [f for f in forms if distance(key, f)[0] <= 2 and len(key) >= 6]
        assert not near or d._near(key) is not None, (key, near)


def test_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, axis string, value string, aliases array<string>")
    s = spark.createDataFrame([(1, "Noun", ["informal", "", None, "Formal", "xx"], 5), (2, None, None, 5), (3, "noun", [], 5), (1, "Noun", ["informal", "", None, "Formal", "xx"], 5), (4, " ", None, 5)], "id long, pos string, labels array<string>, ord int")
    label = spark.createDataFrame([(9, "region", "BRE"), (10, "register", "BRE"), (11, None, "BRE"), (12, "region", None)], "id long, axis string, value string")
    got = sorted(map(tuple, mapped(typed_values(s, label), items).collect()))
    assert got == sorted([("s_sense.labels", 1, 3, 2), ("s_sense.labels", 1, 4, MISS), ("s_sense.pos", 1, 0, 4), ("s_sense.pos", 4, 0, MISS), ("label.value", 9, 0, 3), ("label.value", 10, 0, MISS), ("label.value", 11, 0, MISS)])
    assert mapped(typed_values(s.limit(0), label.limit(0)), items).count() == 0
    assert {r[3] for r in mapped(typed_values(s, label), items.limit(0)).collect()} == {MISS}
    assert [len(b) for b in reference(items, 4)] == [4, 2] and list(reference(items.limit(0))) == []


def test_blocks_and_other_weakening_words(spark):
    """A list in blocks gives what the whole list gives; the weakening words are a parameter."""
    items = spark.createDataFrame(ITEMS, "item_id long, axis string, value string, aliases array<string>")
    values = ["infromal", "archi.", "archa.", "nformal", "(colloquial)", "xx", "familiars tyle", "almost formal", "informal", "foraml", "n", "名词,"] * 3
    s = spark.createDataFrame([(i, v, [v], 5) for i, v in enumerate(values)], "id long, pos string, labels array<string>, ord int")
    label = spark.createDataFrame([], "id long, axis string, value string")
    one, many = (sorted(map(tuple, mapped(typed_values(s, label), items, block_items=n).collect())) for n in (100, 1))
    assert one == many
    assert dict((r[1], r[3]) for r in one if r[0] == "s_sense.labels")[7] == MISS
    got = mapped(typed_values(s, label), items, hedges=("almost",)).where("field = 's_sense.labels' and id = 7").first()
    assert got.item_id == 2
