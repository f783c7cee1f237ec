"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every larger (``large``) or every smaller neighbour of a node to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    # Links point from the larger to the smaller node.
    return out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node with a link; the label is the least node of the component.

    ``edges (u, v)`` may repeat links, hold them both ways and link a node to
    itself.  A component of n nodes takes about log(n) rounds; each round is
    written to the shared scratch folder, so a lost executor costs one round.
    """
    now = materialise(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        after = materialise(_star(materialise(_star(now, large=True), "links-large"), large=False), "links-small")
        # Stars do not change any more: every node links to one least node, which links nowhere.
        state = after.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        discard(now)
        now = after
        if state == seen:
            break
        seen = state
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
