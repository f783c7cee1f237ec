"""Attribute drop: product attributes per class or subclass under varying headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import to_long
from ..functions.text import clean_id, text_trim
from ..operators.dedup import keep_first
from ..operators.select import column_or_null, empty_frame, find_column, with_label
from ..schemas import CHILD_ATTRIBUTES, PARENT_ATTRIBUTES

# Header spellings, first match wins (fixed values).
FUND_ID = ("CNPJ Fundo", "CNPJ_Fundo", "CNPJ do Fundo")
CLASS_ID = ("CNPJ Classe", "CNPJ_Classe", "CNPJ da Classe")
STRUCTURE = ("Estrutura",)
SUBCLASS_CODE = ("Código CVM Subclasse", "Codigo CVM Subclasse")
ATTRIBUTES = {
    "classificacao_anbima": ("Tipo ANBIMA",),
    "composicao_fundos": ("Composição do Fundo", "Composição dos Fundos", "Composicao do Fundo"),
    "tributacao_alvo": ("Tributação Alvo", "Tributacao Alvo"),
    "aplicacao_minima": ("Aplicação Inicial Mínima", "Aplicacao Inicial Minima"),
}
REDEMPTION_DAYS = (
    "Prazo Pagamento Resgate em dias",
    "Prazo de Pagamento Resgate em dias",
    "Prazo Pagamento Resgate (dias)",
)


def _attribute_columns(drop: DataFrame) -> list[Column]:
    days = find_column(drop, *REDEMPTION_DAYS)
    days_col = to_long(F.col(f"`{days}`").cast("string")) if days else F.lit(None).cast("bigint")
    return [column_or_null(drop, names, alias) for alias, names in ATTRIBUTES.items()] + [
        days_col.alias("prazo_de_resgate")
    ]


def parent_attributes(drop: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Rows of structure "classe", one per (fund id, class id)."""
    fund, cls = find_column(drop, *FUND_ID), find_column(drop, *CLASS_ID)
    if not (fund and cls):
        return empty_frame(drop.sparkSession, PARENT_ATTRIBUTES)
    kept = with_label(drop, find_column(drop, *STRUCTURE), "classe").select(
        clean_id(F.col(f"`{fund}`")).alias("cnpj_fundo"),
        clean_id(F.col(f"`{cls}`")).alias("cnpj_classe"),
        *_attribute_columns(drop),
        *order,
    )
    values = [f.name for f in PARENT_ATTRIBUTES.fields[2:]]
    return keep_first(kept, ["cnpj_fundo", "cnpj_classe"], [*order, *values]).drop(*order)


def child_attributes(drop: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Rows of structure "subclasse", ready for the two-pass match (not made unique)."""
    fund, cls = find_column(drop, *FUND_ID), find_column(drop, *CLASS_ID)
    code = find_column(drop, *SUBCLASS_CODE)
    if not (fund and cls and code):
        return empty_frame(drop.sparkSession, CHILD_ATTRIBUTES)
    return with_label(drop, find_column(drop, *STRUCTURE), "subclasse").select(
        text_trim(F.col(f"`{code}`")).alias("codigo_cvm_subclasse"),
        clean_id(F.col(f"`{fund}`")).alias("cnpj_fundo"),
        clean_id(F.col(f"`{cls}`")).alias("cnpj_classe"),
        *_attribute_columns(drop),
        *order,
    )
