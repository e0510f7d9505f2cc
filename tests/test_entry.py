"""Driver contract: entry() runs, every query has a name-matched oracle, and all agree at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from reelstat.plans import registry
from tools.oracle_check import TABLES, rows_of

from .conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "engagement_score" in df.columns


def test_every_query_has_an_oracle():
    assert set(registry.queries()) <= set(E.queries())
    assert set(registry.queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, res.fetchall())
