"""The registered queries: all there, and equal to their SQL twins where they have one."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from peerscore.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {n for n, (_, sql) in QUERIES.items() if sql} <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    out = QUERIES[name][0](spark, SF)
    rel = con.sql(QUERIES[name][1])
    assert sorted(out.columns) == sorted(rel.columns)
    assert normal(out.columns, out.collect()) == normal(rel.columns, rel.fetchall())
