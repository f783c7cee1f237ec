"""Per-entity metrics against each entity's own reference series."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.calendar import days_since, month_start
from ..functions.numbers import (
    MONTHS_PER_YEAR,
    SQRT_12,
    below_zero,
    finite,
    lookup,
    spread_or_null,
)


@dataclass(frozen=True)
class MetricInputs:
    """What a metric may read besides the dimension it is attached to."""

    monthly: DataFrame
    reference: DataFrame
    series: DataFrame
    as_of: date
    rates: Mapping[str, float | None] = field(default_factory=dict)


def excess_returns(monthly: DataFrame, dim: DataFrame, reference: DataFrame) -> DataFrame:
    """Months in which both the entity and its reference have a return.

    The reference holds one row per configured code and calendar month.  The
    code comes from the dimension, unless ``monthly`` carries ``benchmark``.
    """
    months = monthly.filter(F.col("monthly_ret").isNotNull())
    if "benchmark" not in months.columns:
        months = months.join(dim.select("fund_key", "benchmark"), "fund_key")
    return (
        months.withColumnRenamed("benchmark", "benchmark_code")
        .join(
            reference.filter(F.col("monthly_bench_ret").isNotNull()),
            ["year_month", "benchmark_code"],
        )
        .withColumn("excess", F.col("monthly_ret") - F.col("monthly_bench_ret"))
    )


def _excess_aggregates(excess: Column) -> list[Column]:
    return [
        F.avg(excess).alias("excess_mean"),
        F.stddev_samp(excess).alias("excess_std"),
        F.stddev_samp(below_zero(excess)).alias("downside_std"),
    ]


def excess_statistics(excess: DataFrame) -> DataFrame:
    """Mean, std and std of the negative part per entity: serves both ratios."""
    return excess.groupBy("fund_key").agg(*_excess_aggregates(F.col("excess")))


def information_ratio_expr() -> Column:
    return finite(F.col("excess_mean") / spread_or_null(F.col("excess_std"), F.col("excess_mean")) * SQRT_12)


def sortino_ratio_expr() -> Column:
    downside = spread_or_null(F.col("downside_std"), F.col("excess_mean"))
    return finite(F.col("excess_mean") * MONTHS_PER_YEAR / (downside * SQRT_12))


def attach_information_ratio(dim: DataFrame, monthly: DataFrame, reference: DataFrame) -> DataFrame:
    """Annualised mean/std of excess returns; null without a usable spread."""
    stats = excess_statistics(excess_returns(monthly, dim, reference))
    return dim.join(stats.select("fund_key", information_ratio_expr().alias("information_ratio")), "fund_key", "left")


def attach_sortino_ratio(dim: DataFrame, monthly: DataFrame, reference: DataFrame) -> DataFrame:
    """Annualised mean over the sample std of the negative part about its own mean."""
    stats = excess_statistics(excess_returns(monthly, dim, reference))
    return dim.join(stats.select("fund_key", sortino_ratio_expr().alias("sortino_ratio")), "fund_key", "left")


def attach_label_efficiency(
    dim: DataFrame,
    rates: Mapping[str, float | None],
    label: str = "tributacao_alvo",
    alias: str = "tax_efficiency",
) -> DataFrame:
    """``1 - rate(label)``; a label without a rate, or not listed, gives null."""
    kept = {name: 1.0 - float(rate) for name, rate in rates.items() if rate is not None}
    return dim.withColumn(alias, lookup(kept, F.col(label), "double"))


def latest_known(value: str, date_col: str) -> Column:
    """Aggregate: value on the last date that has one."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(date_col)))


def latest_attributes(series: DataFrame, date_col: str = "dt_comptc") -> DataFrame:
    """Latest known equity and holder count per entity, in one aggregation."""
    return series.groupBy("fund_key").agg(
        latest_known("vl_patrim_liq", date_col).alias("equity"),
        latest_known("nr_cotst", date_col).alias("nr_cotst"),
    )


def attach_equity(dim: DataFrame, series: DataFrame) -> DataFrame:
    return dim.join(latest_attributes(series).select("fund_key", "equity"), "fund_key", "left")


def attach_holders(dim: DataFrame, series: DataFrame) -> DataFrame:
    """Latest holder count; entities without one get 0."""
    out = dim.join(latest_attributes(series).select("fund_key", "nr_cotst"), "fund_key", "left")
    return out.withColumn("nr_cotst", F.coalesce("nr_cotst", F.lit(0)).cast("bigint"))


def attach_age(dim: DataFrame, as_of: date, start: str = "data_de_inicio") -> DataFrame:
    return dim.withColumn("existing_time", days_since(F.col(start), as_of))


# Extension point: a metric is a function of the dimension and the inputs.
METRICS: dict[str, Callable[[DataFrame, MetricInputs], DataFrame]] = {
    "information_ratio": lambda dim, x: attach_information_ratio(dim, x.monthly, x.reference),
    "sortino_ratio": lambda dim, x: attach_sortino_ratio(dim, x.monthly, x.reference),
    "tax_efficiency": lambda dim, x: attach_label_efficiency(dim, x.rates),
    "equity": lambda dim, x: attach_equity(dim, x.series),
    "nr_cotst": lambda dim, x: attach_holders(dim, x.series),
    "existing_time": lambda dim, x: attach_age(dim, x.as_of),
}


def attach_metrics(dim: DataFrame, names: list[str], inputs: MetricInputs) -> DataFrame:
    for name in names:
        dim = METRICS[name](dim, inputs)
    return dim


def entity_statistics(
    flagged: DataFrame,
    reference: DataFrame,
    key: str = "fund_key",
    date_col: str = "dt_comptc",
    level: str = "vl_quota",
    code: str = "benchmark",
) -> DataFrame:
    """Excess statistics and latest attributes per entity in one pass.

    ``flagged`` is the keyed daily series with ``is_jump`` and the entity's
    reference code.  Equal to dropping the jumps, taking monthly returns and
    attaching equity and holders separately, but everything rides on the one
    exchange that partitioned the series by entity.  Attributes read all rows,
    returns only those without a jump.
    """
    clean_date = F.when(~F.col("is_jump"), F.col(date_col))
    w = Window.partitionBy(key).orderBy("year_month")
    known = F.last("_level", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rolled = (
        # The code depends on the key; as a grouping column it keeps the
        # aggregation buffer free of strings, hence hash-based.
        flagged.groupBy(key, F.col(code).alias("benchmark_code"), month_start(F.col(date_col)).alias("year_month"))
        .agg(
            F.count(clean_date).alias("_days"),
            F.max_by(level, clean_date).alias("_level"),
            latest_known("vl_patrim_liq", date_col).alias("_equity"),
            F.max(F.when(F.col("vl_patrim_liq").isNotNull(), F.col(date_col))).alias("_equity_date"),
            latest_known("nr_cotst", date_col).alias("_holders"),
            F.max(F.when(F.col("nr_cotst").isNotNull(), F.col(date_col))).alias("_holders_date"),
        )
        .withColumn("_known", known)
        # A month of jumps only has no return; its carried level is the one
        # before, so the next month still compares with the right one.
        .withColumn(
            "monthly_ret",
            F.when(F.col("_days") > 0, F.try_divide(F.col("_known"), F.lag("_known").over(w)) - 1),
        )
    )
    excess = F.col("monthly_ret") - F.col("monthly_bench_ret")
    return (
        rolled.join(reference, ["year_month", "benchmark_code"], "left")
        .groupBy(key)
        .agg(
            *_excess_aggregates(excess),
            F.max_by("_equity", "_equity_date").alias("equity"),
            F.max_by("_holders", "_holders_date").alias("nr_cotst"),
        )
    )
