"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from txnlake.plans import catalog, oracle  # noqa: E402
from check_oracle import TABLES, _close, _rows  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "transaction_count" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(oracle.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _close(_rows(cols, rows), _rows(ocols, orows))
