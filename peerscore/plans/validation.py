"""Anchor-to-anchor return per entity, a cross-check of the score."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.anchors import anchor_returns
from ..operators.match import entity_dimension


def named_entities(classes: DataFrame, subclasses: DataFrame) -> DataFrame:
    """Both levels with a display name."""
    return entity_dimension(
        classes.withColumn("nome", F.col("denom_social_classe")),
        subclasses.withColumn("nome", F.col("denom_social_subclasse")),
        ["cnpj_fundo", "nome"],
    )


def calendar_year_return(classes: DataFrame, subclasses: DataFrame, series: DataFrame, year: int) -> DataFrame:
    """``retorno_<year>``: last level of the year over last level of the year before, minus one."""
    alias = f"retorno_{year}"
    out = anchor_returns(
        named_entities(classes, subclasses), series, date(year - 1, 12, 31), date(year, 12, 31), alias
    )
    return out.select("cnpj_fundo", "cnpj_classe", "id_subclasse_cvm", "nome", alias)
