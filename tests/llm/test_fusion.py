import datetime as dt

from lexlake.llm.fusion import survivors

SCHEMA = "id long, cluster long, zh_hans string, kind string, headword string, sources int, dictionary_id long, updated_at timestamp, precision string, o int"
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def run(spark, rows, dictionaries=((1, 0.9), (2, 0.99), (3, None))):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, survivors(df, spark.createDataFrame(list(dictionaries), "id long, precision double")).collect()))


def test_order_of_members(spark):
    rows = [
        (1, 5, "a", "-", None, 1, 1, T1), (2, 5, "b", "N/A", "h", 1, 2, T1), (3, 5, "　", "phrase", "?", 9, 3, T2), (4, 5, "c", "sentence", "h", None, None, None),
        (10, 6, "a", None, None, 1, 1, T1), (11, 6, "b", None, None, 2, 1, T1), (20, 7, None, "", "null", 1, 1, T1), (21, 7, "—", " ", "…", 1, 1, T2),
        (30, 8, "a", "k", "h", 1, 1, T1), (30, 8, "a", "k", "h", 1, 1, T1), (40, None, "a", "k", "h", 1, 1, T1), (50, 9, "a", "k", "h", 1, 1, T1), (51, 9, "a", "k", "h", 1, 1, T1),
    ]
    assert run(spark, rows) == sorted([
        (5, "zh_hans", 2), (5, "kind", 3), (5, "headword", 2), (5, "representative", 4), (6, "zh_hans", 11), (6, "representative", 11), (7, "representative", 21),
        (9, "zh_hans", 50), (9, "kind", 50), (9, "headword", 50), (9, "representative", 50),
    ])


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, 1, "a", "b", "c", 1, 1, T1)]) == []
    assert len(run(spark, [(1, 1, "a", "b", "c", 1, 1, T1), (2, 1, "a", "b", "c", 1, 1, T1)], [(9, 0.1)])) == 4
