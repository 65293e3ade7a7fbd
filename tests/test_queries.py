"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest
from conftest import DATA

import __spark_entry__ as entry
from signalguard.plans.oracles import SQL
from signalguard.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def rows(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if v is None or v is pd.NaT or v != v:
            return "NULL"
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    ours = entry.queries()[name](spark, DATA).toPandas()
    theirs = duck.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
