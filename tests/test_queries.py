"""Every query with check SQL against the check engine on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_check_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query(spark, engine, key):
    df = entry.queries()[key](spark, SMALL)
    result = engine.execute(entry.oracle_sql()[key])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, map(tuple, df.collect())) == canonical(names, result.fetchall())
