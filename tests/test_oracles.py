"""Every registered query against its SQL, run by an independent engine."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from userflow.plans import batch, streams
from userflow.plans.oracles import ORACLES

QUERIES = {**batch.QUERIES, **streams.QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return "" if value is None else repr(value) if isinstance(value, float) else str(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    expected = canonical(columns, want.fetchall())
    assert expected
    assert canonical(got.columns, got.collect()) == expected


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert result.columns == ["country", "avg_age", "count"]
    assert result.count() > 1
