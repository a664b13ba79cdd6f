"""Every registered query at sf0.001 against its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as E
import oracles
from ledgerlark import queries as Q
from ledgerlark.sources.adapter import TABLES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
NAMES = sorted(Q.REGISTRY)  # those of the training-data operators are compared in tests/llm


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "transaction_count" in df.columns


def test_every_query_has_an_oracle():
    assert set(Q.REGISTRY) == set(oracles.SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols, rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    rel = duck.sql(oracles.SQL[name])
    dcols, drows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    sh, sl = digest(cols, rows)
    dh, dl = digest(dcols, drows)
    assert sh == dh, (sorted(set(sl) - set(dl))[:3], sorted(set(dl) - set(sl))[:3])
