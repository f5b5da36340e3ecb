"""Registered queries against DuckDB, where SQL can express them."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from lakemarts.llm.oracles import LLM_ORACLES

DATA_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_same_rows(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA_DIR}/{table}.parquet')")
    result = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    frame = contract.queries()[name](spark, DATA_DIR)
    assert sorted(frame.columns) == sorted(columns)
    theirs = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(row)) for row in frame.select(*columns).collect()) == theirs


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    for number in range(1, 14):
        assert len([name for name in names if name.startswith(f"op{number}_")]) == 1
    assert "pipeline" in names
