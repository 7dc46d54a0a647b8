"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import os
import sys

import pytest
from conftest import ROOT, SF0001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import duck, frame_rows, type_mismatches  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert [r["reason"] for r in rows][-1] == "kept" and sum(r["rows"] for r in rows) > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF0001)
    assert type_mismatches(sdf, con, SQL[name]) == []
    got = sdf.toPandas()
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert frame_rows(got) == frame_rows(want)
