"""Every registered query against its DuckDB oracle on the smallest tables."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from strata.plans.queries import ORACLE, QUERIES

spec = importlib.util.spec_from_file_location("oc", Path(__file__).resolve().parents[1] / "tools" / "oracle_check.py")
oc = importlib.util.module_from_spec(spec)
spec.loader.exec_module(oc)

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in oc.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["AccountNo", "TotalDeposits", "TotalWithdrawals", "NetBalance", "LastTransactionDate"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    srows = [tuple(r[i] for i in order) for r in df.collect()]
    if name not in E.oracle_sql():
        assert len(srows) > 0
        return
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    orows = [tuple(r[i] for i in oorder) for r in cur.fetchall()]
    assert sorted(cols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert oc.digest(srows)[0] == oc.digest(orows)[0]
