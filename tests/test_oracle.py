"""Every query that has oracle SQL gives the oracle's rows."""

import os

import duckdb
import pandas as pd
import pytest

from lumenfold.plans import load_all
from lumenfold.plans.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.01"
load_all()


@pytest.fixture(scope="module")
def oracle():
    db = duckdb.connect()
    for name in os.listdir(DATA):
        db.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return db


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    return float(f"{v:.9g}") if isinstance(v, float) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=lambda r: tuple((x is not None, str(type(x) is str), x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, DATA)
    expected = oracle.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
