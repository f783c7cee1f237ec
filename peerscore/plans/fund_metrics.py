"""Metrics and score per investable entity."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.match import attach_entity_key, entity_dimension
from ..operators.metrics import (
    attach_age,
    attach_label_efficiency,
    entity_statistics,
    information_ratio_expr,
    sortino_ratio_expr,
)
from ..operators.reference import monthly_reference_returns
from ..operators.returns import JUMP_SIGMA, JUMP_WINDOW, daily_log_returns, flag_jumps
from ..operators.score import ScoringConfig, peer_score
from ..operators.select import on_or_before
from ..schemas import FUND_METRICS
from .settings import REFERENCE_UNITS, SCORING

CARRIED = ("situacao", "publico_alvo", "benchmark", "tributacao_alvo", "data_de_inicio")


def entity_metrics(
    classes: DataFrame,
    subclasses: DataFrame,
    series: DataFrame,
    reference: DataFrame,
    as_of: date,
    config: ScoringConfig = SCORING,
    units: Mapping[str, tuple[str, str]] = REFERENCE_UNITS,
    window: int = JUMP_WINDOW,
    sigma: float = JUMP_SIGMA,
) -> DataFrame:
    """Unscored metrics: the series is read once and exchanged once, by entity."""
    dim = entity_dimension(classes, subclasses, CARRIED)
    keyed = attach_entity_key(on_or_before(series, "dt_comptc", as_of), dim, extra=["benchmark"])
    flagged = flag_jumps(daily_log_returns(keyed), window=window, sigma=sigma)
    stats = entity_statistics(flagged, monthly_reference_returns(reference, units)).select(
        "fund_key",
        information_ratio_expr().alias("information_ratio"),
        sortino_ratio_expr().alias("sortino_ratio"),
        "equity",
        F.col("nr_cotst").alias("_holders"),
    )
    out = dim.join(stats, "fund_key", "left").withColumn("nr_cotst", F.coalesce("_holders", F.lit(0)).cast("bigint"))
    return attach_age(attach_label_efficiency(out, config.rates or {}), as_of).select(
        "fund_key", *[c for c in FUND_METRICS.fieldNames() if c != "score"]
    )


def fund_metrics(
    classes: DataFrame,
    subclasses: DataFrame,
    series: DataFrame,
    reference: DataFrame,
    as_of: date,
    config: ScoringConfig = SCORING,
    units: Mapping[str, tuple[str, str]] = REFERENCE_UNITS,
    window: int = JUMP_WINDOW,
    sigma: float = JUMP_SIGMA,
    store: Callable[[DataFrame], DataFrame] = lambda metrics: metrics,
) -> DataFrame:
    """The published 12 columns, plus ``fund_key`` in front.

    The moments and the composite both read the metrics, so with a costly
    series pass a ``store`` that writes them.
    """
    metrics = entity_metrics(classes, subclasses, series, reference, as_of, config, units, window, sigma)
    return peer_score(store(metrics), config)
