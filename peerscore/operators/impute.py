"""Mode imputation of nulls and outliers, and label mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import lookup

SIGMAS = 3.0


def mode_bounds(df: DataFrame, columns: Sequence[str], sigmas: float = SIGMAS) -> DataFrame:
    """Per column: mode, mean, sample std and the bounds mean -/+ ``sigmas`` std.

    The mode comes from counted values, not from one task's map of them; ties
    go to the smallest value.  A column without values has all nulls.
    """
    moments = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in columns],
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"mean_{c}").alias("mean"),
                        F.when(F.col(f"mean_{c}").isNotNull(), F.coalesce(f"std_{c}", F.lit(0.0))).alias("std"),
                    )
                    for c in columns
                ]
            )
        )
    )
    modes = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .count()
        .groupBy("column")
        .agg(F.max_by("value", F.struct("count", -F.col("value"))).alias("mode"))
    )
    return moments.join(modes, "column", "left").select(
        "column",
        "mode",
        "mean",
        "std",
        (F.col("mean") - sigmas * F.col("std")).alias("lo"),
        (F.col("mean") + sigmas * F.col("std")).alias("hi"),
    )


def impute_with_mode(df: DataFrame, columns: Sequence[str], stats: DataFrame) -> DataFrame:
    """Null or out-of-bounds values become the mode of ``stats``.

    ``stats`` is :func:`mode_bounds` of this frame or of another one.  It has a
    row per column, so it enters as a scalar subquery.  A column whose
    statistics are null is left alone.
    """
    packed = stats.agg(
        F.map_from_entries(
            F.collect_list(F.struct("column", F.struct("mode", "lo", "hi").alias("s")))
        ).alias("stats")
    ).scalar()
    out = {}
    for c in columns:
        s = F.try_element_at(F.col("_stats"), F.lit(c))
        bad = F.col(c).isNull() | (F.col(c) < s["lo"]) | (F.col(c) > s["hi"])
        out[c] = F.when(s["mode"].isNotNull() & bad, s["mode"]).otherwise(F.col(c))
    return df.withColumn("_stats", packed).withColumns(out).drop("_stats")


def map_labels(df: DataFrame, column: str, mapping: dict[str, str], null_label: str) -> DataFrame:
    """Dictionary replace: unknown labels stay, nulls become ``null_label``."""
    mapped = F.coalesce(lookup(mapping, F.col(column), "string"), F.col(column), F.lit(null_label))
    return df.withColumn(column, mapped)
