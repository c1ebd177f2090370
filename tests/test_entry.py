"""Driver contract: entry() runs on sf0.001; every oracle has a query."""

import os

import pytest

import __spark_entry__ as E
from paths import SF_SMALL


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert set(df.columns) >= {"model_name", "total", "exact_match", "exact_match_pct"}


def test_oracles_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
def test_query_columns_are_aliased(spark):
    import re

    from callcorpus.plans.queries import QUERIES

    for name, fn in QUERIES.items():
        assert E.queries()[name] is fn
        cols = fn(spark, SF_SMALL).columns
        assert all(re.fullmatch(r"[a-z_][a-z0-9_]*", c) for c in cols), (name, cols)
        assert len(cols) == len(set(cols)), (name, cols)
