"""The series in buckets of its entity: same numbers, no exchange below the windows."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from peerscore.catalog import frames as f
from peerscore.catalog import series_queries as q
from peerscore.operators.anchors import anchor_levels, anchor_returns
from peerscore.plans import fund_metrics as plan
from peerscore.plans.entity_series import TABLE, read_entity_series, write_entity_series
from peerscore.plans.validation import named_entities
from peerscore.sources import tables


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("published"))
    write_entity_series(f.quotas(spark, SF_SMALL), root, f.AS_OF)
    return root


def above_scan(df, mark):
    """Operators above the scan of ``mark`` in the physical plan, the nearest first."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    nodes = [(len(line) - len(line.lstrip(" :+-")), line.lstrip(" :+-")) for line in lines]
    at = next(i for i, (_, text) in enumerate(nodes) if "FileScan" in text and mark in text)
    depth, found = nodes[at][0], []
    for indent, text in reversed(nodes[:at]):
        if indent < depth:
            depth = indent
            found.append(text)
    return found


def metrics(spark, series):
    dim = f.classes(spark, SF_SMALL), f.subclasses(spark, SF_SMALL)
    return plan.entity_metrics(*dim, series, q._wide(spark, SF_SMALL), f.AS_OF, config=f.SCORING, units=f.UNITS, window=f.WINDOW, sigma=f.SIGMA)


def same(left, right):
    key = lambda r: str(r)
    got, want = sorted(map(tuple, left.collect()), key=key), sorted(map(tuple, right.select(left.columns).collect()), key=key)
    assert len(got) == len(want) > 0
    for a, b in zip(got, want):
        assert all(x == pytest.approx(y) if isinstance(x, float) else x == y for x, y in zip(a, b))


def test_metrics_without_exchange(spark, root):
    stored = metrics(spark, read_entity_series(spark, root, f.AS_OF))
    path = above_scan(stored, "by_key_")
    until = next(i for i, text in enumerate(path) if text.startswith("Window"))
    assert not [text for text in path[:until] if "Exchange" in text]
    same(stored, metrics(spark, f.quotas(spark, SF_SMALL)))


def test_anchors_without_exchange(spark, root):
    series = read_entity_series(spark, root, f.AS_OF)
    assert not [text for text in above_scan(anchor_levels(series, *f.ANCHORS), "by_key_") if "Exchange" in text]
    dim = named_entities(f.classes(spark, SF_SMALL), f.subclasses(spark, SF_SMALL))
    same(anchor_returns(dim, series, *f.ANCHORS, "ret"), anchor_returns(dim, f.quotas(spark, SF_SMALL), *f.ANCHORS, "ret"))


def test_read_in_a_session_that_did_not_write(spark, root):
    version = tables.current_path(spark, root, "silver", TABLE, f.AS_OF).rsplit("/", 1)[1]
    spark.sql(f"DROP TABLE {tables._table_of(version)}")
    stored = read_entity_series(spark, root, f.AS_OF)
    assert not [text for text in above_scan(stored.groupBy("fund_key").count(), "by_key_") if "Exchange" in text]
    assert stored.count() == f.quotas(spark, SF_SMALL).count()


def test_old_versions_leave_the_catalog(spark, tmp_path):
    rows = f.quotas(spark, SF_SMALL).limit(20)
    written = [write_entity_series(rows, str(tmp_path), f.AS_OF, buckets=2) for _ in range(tables.KEPT + 1)]
    there = [spark.catalog.tableExists(tables._table_of(p.rsplit("/", 1)[1])) for p in written]
    assert there == [False, *[True] * tables.KEPT]
    assert read_entity_series(spark, str(tmp_path), f.AS_OF).count() == 20


def test_a_plain_table_has_no_buckets(spark, tmp_path):
    tables.write_table(f.quotas(spark, SF_SMALL), str(tmp_path), "silver", TABLE, f.AS_OF)
    with pytest.raises(ValueError):
        read_entity_series(spark, str(tmp_path), f.AS_OF)
