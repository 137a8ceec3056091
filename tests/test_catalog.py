"""Every query of the catalog against its reference SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, kinds, normal
from forecourt.catalog.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables absent")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return connection


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_reference(spark, db, name):
    got = QUERIES[name](spark, SF_DIR)
    want = db.sql(ORACLES[name])
    types = kinds(dict(got.dtypes))
    assert types == {c: kinds({c: str(t)})[c] for c, t in zip(want.columns, want.types)}
    a, b = normal(got.toPandas()), normal(want.df())
    assert len(a) == len(b)
    assert a.equals(b), a[(a != b).any(axis=1)].head()


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
