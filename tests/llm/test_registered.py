"""Registered queries of the subpackage at sf0.001: those with SQL against DuckDB, the listed others by their columns."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlark.llm import oracles, queries
from ledgerlark.sources.adapter import TABLES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
WITHOUT_SQL = {"op2_repeated_passages", "op4_nearest", "op5_simhash", "op6_token_files", "op7_token_counts", "op9_byte_bpe", "op10_quality",
               "op11_language", "op13_spelling", "pipeline"}


def test_all_are_registered():
    assert set(queries.REGISTRY) <= set(E.queries()) and set(oracles.SQL) <= set(E.oracle_sql())
    assert set(queries.REGISTRY) - set(oracles.SQL) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.REGISTRY[name](spark, SF)
    rel = con.sql(oracles.SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]
