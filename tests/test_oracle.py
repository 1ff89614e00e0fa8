"""Every catalog key against its DuckDB oracle (sf0.001; the driver runs sf0.01)."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from slotwise.plans import catalog
from tools.check_oracle import _rows, duck

#: The reference's own operators; the training-data queries are covered by their own tests.
KEYS = list(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(entry.queries())
    assert set(KEYS) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "fill_rate" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in sdf.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert len(rows) > 0
        return
    rel = con.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(sdf.columns, rows) == _rows(ocols, orows)
