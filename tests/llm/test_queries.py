"""The registered queries of this subpackage against their SQL."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from txnlake.llm import queries

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

from check_oracle import TABLES, _close, _rows  # noqa: E402

SF = "/root/testdata/sf0.001"
# held against brute force, the library itself or held-out labels in this folder
WITHOUT_SQL = {
    "op1_bpe", "op2_html_text", "op3_hidden_markov", "op4_quality_trees", "op6_toxicity",
    "op7_fuzzy_hash", "op11_packing", "op13_spelling", "pipeline",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_is_registered_and_has_sql_or_is_listed():
    names = {*queries.queries(), "pipeline"}
    assert names <= set(entry.queries())
    assert {n for n in names if n not in entry.oracle_sql()} == WITHOUT_SQL
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality", "near_copies", "mixing", "encoding"
    ]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = queries.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(queries.oracle_sql()[name])
    columns, expected = [d[0] for d in result.description], result.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(expected) > 0
    assert _close(_rows(df.columns, rows), _rows(columns, expected))
