"""Every registered query against its SQL in a second engine."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from lakemarts.registry.oracles import ORACLES
from lakemarts.registry.queries import QUERIES

DATA_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA_DIR}/{name}.parquet')"
        )
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, DATA_DIR)
    result = duck.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    theirs = sorted(map(repr, result.fetchall()))
    ours = sorted(repr(tuple(row)) for row in frame.select(*columns).collect())
    assert len(ours) == len(theirs)
    assert ours == theirs
    assert ours, "a query over the given tables should find something"


def test_flagship_runs(spark):
    assert contract.entry(spark).count() > 0
