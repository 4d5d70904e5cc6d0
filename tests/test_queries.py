"""Every query with SQL against DuckDB on the smallest tables; the others only run."""

import duckdb
import pytest

import __spark_entry__ as entry
from leksika.plans import catalogue
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = catalogue.QUERIES[name](spark, SF)
    rows = [tuple(map(repr, r)) for r in found.select(*sorted(found.columns)).collect()]
    if name not in catalogue.SQL:
        assert rows
        return
    cursor = duck.execute(catalogue.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    expected = [tuple(repr(r[i]) for i in order) for r in cursor.fetchall()]
    assert sorted(rows) == sorted(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
