"""Every registered key equals its DuckDB oracle (rows, columns, values) on the test tables."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from compare import duck, rows_of  # noqa: E402

# every query with SQL; corpus queries that SQL cannot express have their own tests
KEYS = sorted(oracle_sql())
SF = os.environ.get("TEST_ORACLE_SF", SF_SMALL)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_key_has_an_oracle():
    from stationflow.plans.catalog import QUERIES

    assert [k for k in QUERIES if k not in oracle_sql()] == []


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF)
    c1, r1 = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(oracle_sql()[key])
    c2, r2 = rows_of([d[0] for d in res.description], res.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "monthly_recovery_pct" in df.columns
