"""Every registered query against its SQL in DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as e
from recordsieve.catalog.oracle import ORACLE
from recordsieve.catalog.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    df = df.astype(object).where(df.notna(), None)
    return sorted((tuple(r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(e.oracle_sql()))
def test_query(spark, db, name):
    got = e.queries()[name](spark, SF_DIR)
    want = db.sql(e.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    got, want = rows(got.toPandas()), rows(want.df())
    assert len(got) == len(want) and len(got) > 0
    assert got == want


def test_entry(spark):
    assert e.entry(spark).count() == 200
