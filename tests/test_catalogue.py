import os

import pytest

from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names])))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_says_what_its_sql_says(spark, duck, name):
    got = rows(catalogue.queries()[name](spark, DATA).toArrow())
    assert got == rows(duck.sql(catalogue.oracle_sql()[name]).to_arrow_table())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_runs(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() > 0
