"""De-duplication with a stated winner.

All three forms filter ``row_number() = 1``.  Spark turns that into a group
limit that also runs before the exchange, so every map task sends at most one
row per key: a key that holds a third of the table still reaches its reducer
as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RN = "_keep_rn"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order; null keys equal each other."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_record(
    df: DataFrame, key: str, date: str, ordinal: Sequence[Column | str] = ()
) -> DataFrame:
    """Row with the latest date per key; null dates lose, ties keep ``ordinal`` order."""
    return keep_first(df, [key], [F.col(date).desc_nulls_last(), *ordinal])


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where the caller does not care which: the smallest row."""
    rest = [c for c in df.columns if c not in keys]
    return keep_first(df, keys, [F.col(c) for c in rest] or list(keys))
