"""The queries of problems 2 to 9 over the smallest tables."""

import pytest
from compare import same

from lexlake.llm.queries import QUERIES, SQL

COLUMNS = {
    "p2_found": [("field", "string"), ("id", "bigint"), ("ord", "bigint"), ("item_id", "bigint")],
    "p3_found": [("tbl", "string"), ("id", "string"), ("lang", "string")],
    "p4_found": [("first_id", "bigint"), ("copy_id", "bigint")],
    "p5_found": [("cluster", "bigint"), ("field", "string"), ("pair_id", "bigint")],
    "p6_found": [("tbl", "string"), ("id_a", "bigint"), ("id_b", "bigint")],
    "p7_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p9_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, small, name):
    same(spark, small, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.dtypes == COLUMNS.get(name, df.dtypes)
    assert df.count() == df.distinct().count() > 0


def test_columns(spark, small):
    for name, columns in COLUMNS.items():
        assert QUERIES[name](spark, small).dtypes == columns


def test_no_import_from_elsewhere():
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    for f in (root / "lexlake").rglob("*.py"):
        if "llm" not in f.parts:
            assert "lexlake.llm" not in f.read_text(), f
