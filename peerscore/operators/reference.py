"""Reference (benchmark) series: long and wide shapes, and monthly returns by unit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_start
from ..functions.casts import percent
from ..functions.numbers import lookup
from .returns import period_change

PERCENT_PER_DAY = "percent_per_day"
PERCENT_PER_MONTH = "percent_per_month"
INDEX_LEVEL = "index_level"


def widen(long: DataFrame, codes: Sequence[str], date: str = "data", code: str = "code", value: str = "valor") -> DataFrame:
    """One row per date and one column per code, in the given order.

    Equal to a chain of full outer joins on the date, in one shuffle.  A code
    without rows becomes a null column.
    """
    return long.groupBy(date).pivot(code, list(codes)).agg(F.first(value, ignorenulls=True)).select(date, *codes)


def lengthen(wide: DataFrame, columns: Sequence[str], date: str = "data") -> DataFrame:
    """Back to ``(date, series, valor)`` rows with a value; absent columns are skipped."""
    present = [c for c in columns if c in wide.columns]
    return wide.unpivot([date], present, "series", "valor").filter(F.col("valor").isNotNull())


def compounded(rate: Column) -> Column:
    """Aggregate: daily percents compounded into one fraction; nulls are skipped."""
    return F.product(percent(rate) + 1.0) - 1.0


def first_published(rate: Column, date: Column) -> Column:
    """Aggregate: the period's first published percent, as a fraction."""
    return percent(F.min_by(rate, F.when(rate.isNotNull(), date)))


def last_level(level: Column, date: Column) -> Column:
    """Aggregate: the period's last known level."""
    return F.max_by(level, F.when(level.isNotNull(), date))


def level_returns(long: DataFrame, key: str = "series", date: str = "data", value: str = "valor") -> DataFrame:
    """Month-end change of a level series; its first month is dropped."""
    ends = (
        long.filter(F.col(value).isNotNull())
        .groupBy(key, month_start(F.col(date)).alias("year_month"))
        .agg(last_level(F.col(value), F.col(date)).alias("level"))
    )
    changed = period_change(ends, "level", "year_month", "monthly_bench_ret", key)
    return changed.filter(F.col("monthly_bench_ret").isNotNull()).select(key, "year_month", "monthly_bench_ret")


def monthly_reference_returns(
    wide: DataFrame, units: Mapping[str, tuple[str, str]], date: str = "data"
) -> DataFrame:
    """:func:`monthly_series_returns` of the columns of a wide table."""
    return monthly_series_returns(lengthen(wide, list(units), date), units, date)


def monthly_series_returns(
    long: DataFrame, units: Mapping[str, tuple[str, str]], date: str = "data"
) -> DataFrame:
    """``(year_month, benchmark_code, monthly_bench_ret)`` of every series in ``units``.

    ``long`` has ``(series, date, valor)`` rows; ``units`` maps a series to
    (code, unit).  All three units share one aggregation by series and month;
    the unit then picks its result.
    """
    codes = {c: code for c, (code, _) in units.items()}
    kinds = {c: kind for c, (_, kind) in units.items()}
    v, d = F.col("valor"), F.col(date)
    monthly = (
        long.filter(F.col("series").isin(*units) & F.col("valor").isNotNull())
        .groupBy("series", month_start(d).alias("year_month"))
        .agg(
            compounded(v).alias("_daily"),
            first_published(v, d).alias("_published"),
            last_level(v, d).alias("_level"),
        )
    )
    monthly = period_change(monthly, "_level", "year_month", "_change", "series")
    unit = lookup(kinds, F.col("series"), "string")
    ret = (
        F.when(unit == PERCENT_PER_DAY, F.col("_daily"))
        .when(unit == PERCENT_PER_MONTH, F.col("_published"))
        .otherwise(F.col("_change"))
    )
    return monthly.select(
        "year_month", lookup(codes, F.col("series"), "string").alias("benchmark_code"), ret.alias("monthly_bench_ret")
    ).filter(F.col("monthly_bench_ret").isNotNull())
