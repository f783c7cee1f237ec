"""Wide reference table: one row per date, one column per series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import Watch, unwatched
from ..operators.reference import widen
from ..operators.select import on_or_before
from .settings import ESSENTIAL_SERIES, REFERENCE_COLUMNS


def long_series(pieces: Mapping[str, DataFrame]) -> DataFrame:
    """``(code, data, valor)`` of all series stacked."""
    tagged = [df.select(F.lit(code).alias("code"), "data", "valor") for code, df in pieces.items()]
    return reduce(DataFrame.unionByName, tagged)


def index_series(
    pieces: Mapping[str, DataFrame], as_of: date, columns: Sequence[str] = REFERENCE_COLUMNS, watch: Watch = unwatched
) -> DataFrame:
    """All series side by side up to ``as_of``; a series without rows is a null column."""
    rows = watch(on_or_before(watch(long_series(pieces), "read", "data"), "data", as_of), "up to the reference date", "data")
    return widen(rows, columns)


def missing_essentials(
    pieces: Mapping[str, DataFrame], essentials: Sequence[str] = ESSENTIAL_SERIES
) -> DataFrame:
    """Essential series that brought no rows at all."""
    seen = long_series(pieces).select("code").distinct()
    wanted = seen.sparkSession.createDataFrame([(c,) for c in essentials], "code string")
    return wanted.join(seen, "code", "left_anti")
