"""Every registered query against its DuckDB oracle on the smallest data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import duck, rows_of, same_rows  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_delivery_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [r.asDict() for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    drows = [dict(zip(cols, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(cols)
    assert len(srows) == len(drows)
    assert same_rows(rows_of(srows, sorted(cols), False), rows_of(drows, sorted(cols), False))


def test_entry_returns_contract_columns(spark):
    from shipgauge.schemas import HEALTH_COLUMNS

    df = E.entry(spark)
    assert tuple(df.columns) == HEALTH_COLUMNS
    assert df.count() > 0
