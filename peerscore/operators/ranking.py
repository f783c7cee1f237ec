"""Average-rank percentile of a whole column, without one task holding it.

An unpartitioned window would sort every row in a single task.  Instead the
distinct values with their counts are dealt by range, once, and written with
the number of their range.  Totals of the ranges are summed up, and each range
adds its own running count: together that is the exact rank.  Values are
distinct when they are dealt, so no value, however frequent, weighs more than
one row, and ranges are cut at sampled quantiles, so tails are as wide as they
need to be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialise


def in_ranges(df: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """``(value, n, range)``: one row per distinct non-null value; a range holds only values above those of lower ranges.

    Written at once.  ``ranges`` defaults to the session's shuffle partitions,
    which adaptive execution merges where they are small.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    dealt = counts.repartitionByRange("value") if ranges is None else counts.repartitionByRange(ranges, "value")
    return materialise(dealt.withColumn("range", F.spark_partition_id()), "ranks")


def average_ranks(df: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """``(value, n, avg_rank, total)``: one row per distinct non-null value of ``df``.

    ``n`` is the number of rows holding the value, ``avg_rank`` the mean of the
    1-based positions they occupy, and ``total`` the number of all rows ranked.
    """
    rows = in_ranges(df, value, ranges)
    # One row per range.
    totals = rows.groupBy("range").agg(F.sum("n").alias("_n"))
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "range", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy()).alias("total")
    )
    smaller = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce("_inside", F.lit(0))
    return (
        rows.withColumn("_inside", F.sum("n").over(smaller))
        .join(starts, "range")
        .select("value", "n", (before + (F.col("n") + 1) / 2.0).alias("avg_rank"), "total")
    )


def average_rank_percentile(df: DataFrame, value: str, alias: str, decimals: int = 2) -> DataFrame:
    """``(value, alias)``: average rank over the number of non-null rows, times 100."""
    pct = F.bround(F.col("avg_rank") / F.col("total") * 100.0, decimals)
    return average_ranks(df, value).select("value", pct.alias(alias))
