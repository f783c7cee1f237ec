"""Mixing against its SQL twin where one document outweighs its source."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

from check import normal
from peerscore.llm import mixing

SCHEMA = "doc_id long, text string, source string, _gap string, cut string"


def _early(n: int) -> int:
    """An id that comes first in md5 order among the first ``n`` numbers."""
    return min(range(10_000, 10_000 + n), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


@pytest.mark.parametrize("share", [0.3, 0.6, 1.5])
def test_a_dominating_document_steps_aside(spark, share):
    long_id = _early(2000)
    texts = [(i, "w " * 300, "a") for i in range(1000)] + [(long_id, "w " * 300_000, "a")]
    texts += [(2000 + i, "w " * size, "b") for i, size in enumerate([1, 2, 4000, 1, 3999, 7, 3998, 1, 900, 450, 200, 60])] + [(3000, None, None), (3001, "", "b"), (3002, "x y", None), (3002, "x y", None)]
    df = spark.createDataFrame([(*t, "x", "y") for t in texts], SCHEMA)
    got = mixing.mix(df, share=share)
    rows = got.collect()
    by_source: dict = {}
    for r in rows:
        took, target, sizes = by_source.setdefault(r.source_size, (0, r.target, []))
        by_source[r.source_size] = (took + r.taken, target, [*sizes, (r.size, r.taken)])
    for took, target, sizes in by_source.values():
        # No document taken less often than another could bring the source nearer.
        times = min((t // s for s, t in sizes if s), default=0)
        left = [s for s, t in sizes if s and t // s == times]
        assert not left or all(abs(took + s - target) >= abs(took - target) for s in left if times < 2)
    a = by_source[300 * 1000 + 300_000]
    assert abs(a[0] - a[1]) <= 150
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    rel = con.sql(mixing.mix_sql(share=share).replace("round(t, 6)", "round(t, 4)"))
    cut = got.selectExpr("doc_id", "size", "source_size", "target", "taken", "round(first_position, 4) AS first_position")
    assert normal(cut.columns, cut.collect()) == normal(rel.columns, rel.fetchall())
