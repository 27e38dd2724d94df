"""Every registered query against its DuckDB oracle (the driver's correctness gate).

Runs at sf0.001 by default; set CLAIMWEAVE_ORACLE_SF=/root/testdata/sf0.01 for the driver's size.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from claimweave.plans import load_catalog
from oracle_compare import compare, duck

SF = os.environ.get("CLAIMWEAVE_ORACLE_SF", "/root/testdata/sf0.001")
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in load_catalog()}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toArrow()
    want = con.sql(SQL[name]).to_arrow_table()
    assert compare(got, want) == []


def test_every_query_has_an_oracle():
    assert set(load_catalog()) == set(SQL)
