"""Daily and monthly returns of keyed level series.

Windows here are partitioned by entity.  A series holds at most one row per
entity and day (``operators.dedup`` sees to that), so a window group is
bounded by the calendar, whatever share of the raw rows its entity had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.calendar import month_start
from ..functions.numbers import spread_or_null

JUMP_WINDOW = 60
JUMP_SIGMA = 5.0


def daily_log_returns(
    daily: DataFrame, key: str = "fund_key", date: str = "dt_comptc", level: str = "vl_quota"
) -> DataFrame:
    """Adds ``log_ret``; null on an entity's first row and around levels not above zero."""
    w = Window.partitionBy(key).orderBy(date)
    return daily.withColumn("log_ret", F.ln(F.try_divide(F.col(level), F.lag(level).over(w))))


def flag_jumps(
    daily: DataFrame,
    ret_col: str = "log_ret",
    window: int = JUMP_WINDOW,
    sigma: float = JUMP_SIGMA,
    key: str = "fund_key",
    date: str = "dt_comptc",
) -> DataFrame:
    """Adds ``is_jump``: the return lies more than ``sigma`` trailing stds from the trailing mean.

    The frame is the last ``window`` rows including the current one; with a
    null anywhere in it nothing is flagged.
    """
    w = Window.partitionBy(key).orderBy(date).rowsBetween(-(window - 1), 0)
    z = (F.col(ret_col) - F.col("_mean")) / spread_or_null(F.col("_std"), F.col("_mean"))
    return (
        daily.withColumns(
            {
                "_n": F.count(ret_col).over(w),
                "_mean": F.avg(ret_col).over(w),
                "_std": F.stddev_samp(ret_col).over(w),
            }
        )
        .withColumn("is_jump", F.coalesce((F.col("_n") >= window) & (F.abs(z) > sigma), F.lit(False)))
        .drop("_n", "_mean", "_std")
    )


def drop_jumps(daily: DataFrame) -> DataFrame:
    return daily.filter(~F.col("is_jump"))


def month_end_levels(
    daily: DataFrame, key: str = "fund_key", date: str = "dt_comptc", level: str = "vl_quota", carry: Sequence[str] = ()
) -> DataFrame:
    """Level on an entity's last row of each month, even when that level is null; ``carry`` names columns the key decides."""
    return daily.groupBy(key, *carry, month_start(F.col(date)).alias("year_month")).agg(
        F.max_by(level, date).alias("vl_quota_eom")
    )


def period_change(
    df: DataFrame,
    value: str,
    order: str,
    alias: str,
    key: str,
    carry_forward: bool = True,
) -> DataFrame:
    """Change against the previous row of the key.

    With ``carry_forward`` a null value counts as unchanged (0.0) and the next
    one is compared with the last known value; without it both are null.
    """
    w = Window.partitionBy(key).orderBy(order)
    if not carry_forward:
        return df.withColumn(alias, F.try_divide(F.col(value), F.lag(value).over(w)) - 1)
    known = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        df.withColumn("_known", known)
        .withColumn(alias, F.try_divide(F.col("_known"), F.lag("_known").over(w)) - 1)
        .drop("_known")
    )


def monthly_returns(
    daily: DataFrame, key: str = "fund_key", date: str = "dt_comptc", level: str = "vl_quota", carry: Sequence[str] = ()
) -> DataFrame:
    """``(key, carry.., year_month, vl_quota_eom, monthly_ret)``."""
    return period_change(
        month_end_levels(daily, key, date, level, carry), "vl_quota_eom", "year_month", "monthly_ret", key
    )
