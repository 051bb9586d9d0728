"""Every registered query equals its DuckDB oracle (small scale), and entry() runs."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from linefold.plans.catalog import QUERIES
from linefold.plans.oracles import ORACLES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest, type_mismatches


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(oracle_sql()[name])
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert type_mismatches(df.dtypes, res.columns, res.types) == {}
    assert digest(df.columns, rows) == digest(res.columns, orows)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["time_stamp", "app_id", "count"]
    assert df.count() > 0
