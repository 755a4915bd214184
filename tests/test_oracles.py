"""Every registered query against its SQL on the smallest tables."""

import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from core_helpers import SMALL
from oracles import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def canonical(df):
    def text(value):
        return None if value is None or value is pd.NaT or value != value else str(value)

    df = df[sorted(df.columns)]
    return list(df.columns), sorted(str([text(v) for v in row]) for row in df.itertuples(index=False))


def test_every_query_has_its_sql():
    assert set(entry.QUERIES) == set(ORACLES)


def test_entry_without_the_text_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(entry.queries()) == set(entry.QUERIES)
    assert entry.oracle_sql() == ORACLES


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_equals_sql(testbed, duck, name):
    got = entry.QUERIES[name](testbed).toPandas()
    assert canonical(got) == canonical(duck.sql(ORACLES[name]).df())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
