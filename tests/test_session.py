"""Scratch tables: where they lie and how they go."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from peerscore import session
from peerscore.catalog import frames, match_queries


def test_recorded_scratch_can_be_removed(spark, rows):
    made: list[str] = []
    with session.recorded_scratch(made):
        df = session.materialise(rows("v int", (1,), (2,)), "t")
    session.materialise(df, "outside")
    assert len(made) == 1 and made[0].startswith(session.scratch_root(spark)) and os.path.isdir(made[0])
    session.remove(spark, made)
    assert not os.path.exists(made[0])


def test_discard_takes_the_table_only(spark, rows):
    kept, gone = (session.materialise(rows("v int", (n,)), "t") for n in (1, 2))
    session.discard(gone)
    assert kept.count() == 1
    session.discard(rows("v int", (1,)))  # no scratch table: nothing happens
    with pytest.raises(Exception, match="does not exist|FAILED_READ_FILE"):
        gone.collect()


def test_a_cluster_needs_the_setting(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        applicationId = "app"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())
    Context.master = "local[2]"
    assert session.scratch_root(Session()) == session.scratch_root(Session())


def _largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("build", [match_queries.composite_lookup, frames.quotas])
def test_rows_of_a_task_do_not_grow_with_the_table(spark, monkeypatch, build):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500, raising=False)
    out = build(spark, SF_SMALL)
    assert _largest_task(out) < out.count() / 5  # 6,000 lines in twelve partitions; the session has four
