"""Return between two anchor dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import finite
from .match import series_keys

_KEYS = ["cnpj_fundo_classe_join", "id_subclasse_join"]


def _keys_of(series: DataFrame) -> list[str]:
    return [*_KEYS, *(c for c in ["fund_key"] if c in series.columns)]


def anchor_levels(
    series: DataFrame,
    base: date,
    final: date,
    date_col: str = "dt_comptc",
    level: str = "vl_quota",
) -> DataFrame:
    """Last known level on or before each cutoff, both in one aggregation.

    A ``fund_key`` of the series, which these keys decide, is grouped by as
    well: a series in buckets of it is then not exchanged.
    """
    d = F.col(date_col)
    keyed = _keys_of(series)
    return (
        series.filter((d <= F.lit(max(base, final))) & F.col(level).isNotNull())
        .select(*series_keys(), *keyed[len(_KEYS):], d, level)
        .groupBy(*keyed)
        .agg(
            F.max_by(level, F.when(d <= F.lit(base), d)).alias("base_level"),
            F.max_by(level, F.when(d <= F.lit(final), d)).alias("final_level"),
        )
    )


def anchor_returns(dim: DataFrame, series: DataFrame, base: date, final: date, alias: str) -> DataFrame:
    """Adds ``alias`` to the entity dimension: final over base level minus one.

    Null unless both anchors exist and the base is above zero.
    """
    ret = finite(F.col("final_level") / F.when(F.col("base_level") > 0, F.col("base_level")) - 1)
    return (
        dim.join(anchor_levels(series, base, final), _keys_of(series), "left")
        .withColumn(alias, ret)
        .drop("base_level", "final_level", *_KEYS)
    )
