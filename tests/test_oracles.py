"""Every registered query vs its DuckDB oracle on the smallest driver tables."""

import math
import os

import pytest

import __spark_entry__ as E
from paths import SF_SMALL

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = [r.asDict() for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert len(got) == len(want)
    assert _rows(got, cols) == _rows(want, cols)
