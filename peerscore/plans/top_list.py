"""Published top list per investor profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import display
from ..operators.match import override_attributes
from ..operators.toplist import top_n_by_audience
from .settings import PROFILES, SCORING


def _attributes(dim: DataFrame, key: str, name: str) -> DataFrame:
    return dim.select(
        key,
        F.col("benchmark").alias("benchmark_canonico"),
        F.col(name).alias("nome"),
        F.col("classificacao_anbima").alias("anbima_classification"),
    )


def with_display_attributes(metrics: DataFrame, classes: DataFrame, subclasses: DataFrame) -> DataFrame:
    """Benchmark, name and classification; a subclass's own values win."""
    return override_attributes(
        metrics,
        _attributes(classes, "cnpj_classe", "denom_social_classe"),
        _attributes(subclasses, "id_subclasse_cvm", "denom_social_subclasse"),
        ["benchmark_canonico", "nome", "anbima_classification"],
    )


def top_list(
    metrics: DataFrame,
    classes: DataFrame,
    subclasses: DataFrame,
    profiles: Mapping[str, Sequence[str]] = PROFILES,
    top_n: int = SCORING.top_n,
) -> DataFrame:
    """Best ``top_n`` entities of each profile; names are joined to the winners only."""
    best = top_n_by_audience(metrics, profiles, top_n, tiebreak=["cnpj_classe", "id_subclasse_cvm"])
    return with_display_attributes(best, classes, subclasses)


def displayed(top: DataFrame) -> DataFrame:
    """The thirteen columns as shown, with profile in front."""
    return top.select(
        "profile",
        "rank",
        display.entity_label(F.col("cnpj_classe"), F.col("id_subclasse_cvm")).alias("fund"),
        display.text(F.col("nome")).alias("name"),
        display.text(F.col("anbima_classification")).alias("classification"),
        display.text(F.col("benchmark_canonico")).alias("benchmark"),
        display.text(F.col("tributacao_alvo")).alias("tax_label"),
        display.money(F.col("equity")).alias("equity"),
        display.thousands(F.col("nr_cotst")).alias("holders"),
        display.thousands(F.col("existing_time")).alias("age_days"),
        display.two_decimals(F.col("information_ratio")).alias("information_ratio"),
        display.two_decimals(F.col("sortino_ratio")).alias("sortino_ratio"),
        display.two_decimals(F.col("tax_efficiency")).alias("tax_efficiency"),
        display.two_decimals(F.col("score")).alias("score"),
    )
