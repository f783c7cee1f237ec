"""Every catalog query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from peerscore.catalog import CATALOG

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_a_twin_and_is_registered():
    assert all(sql for _, sql in CATALOG.values())
    assert set(CATALOG) <= set(entry.queries()) and set(CATALOG) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_its_twin(spark, con, name):
    out = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(out.columns) == sorted(rel.columns)
    assert normal(out.columns, out.collect()) == normal(rel.columns, rel.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
