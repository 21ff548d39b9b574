"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

from tabulon import catalog as E
from conftest import ROOT, SF_SMALL
from tabulon.sources.tables import TABLES

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import rows_of  # noqa: E402

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.queries()) == set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
