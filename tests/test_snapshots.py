import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lexlake.operators.bitmaps import Bitmap
from lexlake.operators.snapshots import changes, record_changes

SCHEMA = "snapshot_no int, id string, name string, size long, date string, locations array<struct<folder:string,files:array<struct<name:string,size:long>>,main_name:string,main_size:long>>, loaded_at timestamp, change string, block int"


def loc(*files, folder="f", main="a.mdx"):
    return (folder, [(n, s) for n, s in files], main, 1)


def row(no, key, name="n", size=1, date="2024-01-05", locs=(), day=1):
    return (no, key, name, size, date, list(locs), dt.datetime(2024, 1, day), "x", 7)


def found(spark, rows):
    return sorted(map(tuple, record_changes(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)


@given(st.sets(st.integers(0, 200_000), max_size=300), st.sets(st.integers(0, 200_000), max_size=300), st.booleans())
@settings(max_examples=60, deadline=None)
def test_bitmaps(a, b, dense):
    if dense:
        a |= set(range(0, 20_000, 2))
        b |= set(range(0, 20_000, 3))
    x, y = Bitmap.of(np.array(sorted(a), np.int64)), Bitmap.of(np.array(sorted(b), np.int64))
    assert set(x.and_not(y).ordinals()) == a - b
    assert set(x.and_(y).ordinals()) == a & b
    assert len(x) == len(a) and list(x.ordinals()) == sorted(a)


def test_added_removed_changed(spark):
    a, b = loc(("x", 1), ("y", 2)), loc(("z", 3), folder="g")
    rows = [
        row(1, "same", locs=[a, b]), row(4, "same", date="05-Jan-2024 00:00", locs=[b, loc(("y", 2), ("x", 1))]),
        row(1, "gone"), row(4, "new"), row(1, "size"), row(4, "size", size=2),
        row(1, "null"), row(4, "null", name=None), row(1, "nulls", name=None), row(4, "nulls", name=None),
        row(1, "late", size=5, day=9), row(1, "late", size=6, day=2), row(4, "late", size=5),
        row(1, "files", locs=[a]), row(4, "files", locs=[loc(("x", 1), ("y", 3))]),
    ]
    assert found(spark, rows + rows[:3]) == [(4, "files", "changed"), (4, "gone", "removed"), (4, "new", "added"), (4, "null", "changed"), (4, "size", "changed")]


def test_gaps_first_and_empty(spark):
    assert found(spark, [row(3, "a")]) == []
    assert found(spark, []) == []
    assert found(spark, [row(1, "a"), row(3, "b"), row(9, "a")]) == [(3, "a", "removed"), (3, "b", "added"), (9, "a", "added"), (9, "b", "removed")]


def test_null_key_and_number(spark):
    assert found(spark, [row(1, "a"), row(2, "a"), row(2, None), row(None, "z")]) == [(2, None, "added")]


def test_blocks_agree(spark, small):
    from lexlake.session import table
    from pyspark.sql import functions as F

    df = table(spark, small, "record_snapshot")
    fields = {"name": F.col("name"), "size": F.col("size")}
    one, many = (changes(df, "snapshot_no", "id", "loaded_at", fields, n) for n in (10**9, 10))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_numbers_stay(spark, tmp_path):
    """A key keeps its number when later snapshots, and rows that were late, arrive."""
    from pyspark.sql import functions as F

    fields, store = {"name": F.col("name")}, str(tmp_path / "ordinals")
    early = [row(2, f"k{i}") for i in range(40)]
    late = early + [row(1, f"k{i}") for i in range(30, 50)] + [row(3, f"k{i}") for i in range(20, 60)] + [row(3, None)]

    def run(rows):
        got = changes(spark.createDataFrame(rows, SCHEMA), "snapshot_no", "id", "loaded_at", fields, 10, store)
        return sorted(map(tuple, got.collect()), key=repr)

    assert run(early) == []
    before = {(r.blocks, r.block, r.id): r.ord for r in spark.read.parquet(store).collect()}
    assert run(late) == found(spark, late)
    after = {(r.blocks, r.block, r.id): r.ord for r in spark.read.parquet(store).collect()}
    assert len(before) == 40 and len(after) == 61 and before.items() <= after.items() and {k[0] for k in after} == {4}
    assert len({(b, o) for (_, b, _), o in after.items()}) == 61
    assert run(late) == found(spark, late) and spark.read.parquet(store).count() == 61


def test_empty_store(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([], SCHEMA)
    for _ in range(2):
        assert changes(df, "snapshot_no", "id", "loaded_at", {"name": F.col("name")}, store=str(tmp_path / "o")).count() == 0
