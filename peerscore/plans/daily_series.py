"""Canonical daily series from archives of two schema eras."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import iso_date, to_double, to_long
from ..functions.text import clean_id
from ..operators.dedup import keep_first
from ..operators.match import keep_known_entities
from ..operators.quality import Watch, unwatched
from ..operators.select import on_or_before
from ..schemas import QUOTA_SERIES
from ..sources.archives import LINE_ORDER, has_field

# Which archives win a duplicate: the yearly legacy files come first.
LEGACY_PRIORITY = 0
CURRENT_PRIORITY = 1

SERIES_KEY = ["cnpj_fundo_classe", "id_subclasse", "dt_comptc"]


# Raw field of each typed column (fixed values).
_DOUBLES = {
    "vl_total": "VL_TOTAL",
    "vl_quota": "VL_QUOTA",
    "vl_patrim_liq": "VL_PATRIM_LIQ",
    "captc_dia": "CAPTC_DIA",
    "resg_dia": "RESG_DIA",
}
RAW_FIELDS = [
    "TP_FUNDO_CLASSE", "CNPJ_FUNDO_CLASSE", "CNPJ_FUNDO", "ID_SUBCLASSE", "DT_COMPTC", *_DOUBLES.values(), "NR_COTST",
]


def unify_eras(lines: DataFrame) -> DataFrame:
    """Raw lines of either era to typed canonical columns.

    The header decides the era, whatever folder the archive lay in; a header
    with neither id column contributes nothing.
    """
    current = has_field("CNPJ_FUNDO_CLASSE", RAW_FIELDS)
    return lines.filter(current | has_field("CNPJ_FUNDO", RAW_FIELDS)).select(
        F.when(current, F.col("TP_FUNDO_CLASSE")).alias("tp_fundo_classe"),
        clean_id(F.when(current, F.col("CNPJ_FUNDO_CLASSE")).otherwise(F.col("CNPJ_FUNDO"))).alias("cnpj_fundo_classe"),
        F.when(current, F.col("ID_SUBCLASSE")).alias("id_subclasse"),
        iso_date(F.col("DT_COMPTC")).alias("dt_comptc"),
        *[to_double(F.col(raw)).alias(name) for name, raw in _DOUBLES.items()],
        to_long(F.col("NR_COTST")).alias("nr_cotst"),
        *LINE_ORDER,
    )


def quota_series(lines: DataFrame, as_of: date, watch: Watch = unwatched) -> DataFrame:
    """Typed rows up to ``as_of``, one per entity, sub-entity and day."""
    typed = watch(unify_eras(watch(lines, "lines read")), "typed", "dt_comptc")
    rows = watch(on_or_before(typed, "dt_comptc", as_of), "up to the reference date", "dt_comptc")
    return watch(keep_first(rows, SERIES_KEY, list(LINE_ORDER)), "one per entity and day", "dt_comptc").select(*QUOTA_SERIES.fieldNames())


def quota_series_of(series: DataFrame, classes: DataFrame, subclasses: DataFrame, watch: Watch = unwatched) -> DataFrame:
    """The part of the series that belongs to the listed entities."""
    return watch(keep_known_entities(watch(series, "read"), classes, subclasses), "of listed entities", "dt_comptc").select(*QUOTA_SERIES.fieldNames())
