"""Every core query against its SQL; those without run and keep their columns."""

from importlib import import_module

import pytest
from compare import same

from lexlake.plans import CORE

MODULES = [import_module(m) for m in CORE]
QUERIES = {n: f for m in MODULES for n, f in m.QUERIES.items()}
SQL = {n: s for m in MODULES for n, s in m.SQL.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, small, name):
    same(spark, small, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.columns == QUERIES[name](spark, small).columns
    df.collect()


def test_sql_names():
    assert set(SQL) <= set(QUERIES)


def test_entry_without_training_data(spark, small):
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 0
    assert set(QUERIES) <= set(e.queries())
