"""Consolidated data-quality report as one long table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from ..operators.quality import profile_scores, profile_series, profile_table
from ..schemas import CLASS_FUNDS, QUOTA_SERIES, SUBCLASS_FUNDS
from .settings import REFERENCE_COLUMNS

# Table -> (key columns, columns whose nulls are counted) (fixed values).
_CLASS = (["cnpj_classe"], CLASS_FUNDS.fieldNames())
_SUBCLASS = (["id_subclasse_cvm"], SUBCLASS_FUNDS.fieldNames())
_ENTITY = ["cnpj_classe", "id_subclasse_cvm"]
PROFILED = {
    "class_funds": _CLASS,
    "subclass_funds": _SUBCLASS,
    "class_funds_fixed_income": _CLASS,
    "subclass_funds_fixed_income": _SUBCLASS,
    "class_funds_fixed_income_treated": _CLASS,
    "subclass_funds_fixed_income_treated": _SUBCLASS,
    "quota_series_fixed_income": (["cnpj_fundo_classe", "id_subclasse", "dt_comptc"], QUOTA_SERIES.fieldNames()),
    "validacao": (_ENTITY, []),  # its one value column is named after the year
    "fund_metrics": (
        _ENTITY,
        ["cnpj_classe", "id_subclasse_cvm", "benchmark", "information_ratio", "equity", "nr_cotst", "existing_time", "score"],
    ),
}


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of the given tables; an unknown name is an error, a missing one is skipped."""
    parts = []
    for name, df in tables.items():
        if name == "index_series":
            parts.append(profile_series(df, name, REFERENCE_COLUMNS))
            continue
        keys, columns = PROFILED[name]
        if name == "validacao":
            columns = [c for c in df.columns if c.startswith("retorno_")]
        parts.append(profile_table(df, name, keys, columns))
        if name == "fund_metrics":
            parts.append(profile_scores(df, name))
    return reduce(DataFrame.unionByName, parts)
