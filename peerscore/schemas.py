"""Column order and types of the typed and published tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "double": DoubleType(),
    "bigint": LongType(),
    "date": DateType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
}


def struct(spec: str) -> StructType:
    """``"a string, b double"`` to a schema, without needing a session."""
    fields = (part.split() for part in spec.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


_ATTRIBUTES = (
    "classificacao_anbima string, composicao_fundos string, tributacao_alvo string, "
    "aplicacao_minima string, prazo_de_resgate bigint"
)
_STATUS = (
    "situacao string, data_de_inicio date, exclusivo string, publico_alvo string, condominio string"
)
_FEES = "taxa_adm double, taxa_perform double, benchmark string"

CLASS_FUNDS = struct(
    "cnpj_fundo string, cnpj_classe string, denom_social_fundo string, denom_social_classe string, "
    f"{_STATUS}, {_ATTRIBUTES}, {_FEES}"
)
SUBCLASS_FUNDS = struct(
    "cnpj_fundo string, cnpj_classe string, id_subclasse_cvm string, denom_social_subclasse string, "
    f"{_STATUS}, {_ATTRIBUTES}, {_FEES}"
)
QUOTA_SERIES = struct(
    "tp_fundo_classe string, cnpj_fundo_classe string, id_subclasse string, dt_comptc date, "
    "vl_total double, vl_quota double, vl_patrim_liq double, captc_dia double, resg_dia double, "
    "nr_cotst bigint"
)
FUND_METRICS = struct(
    "cnpj_classe string, id_subclasse_cvm string, situacao string, publico_alvo string, "
    "tributacao_alvo string, equity double, nr_cotst bigint, existing_time bigint, "
    "information_ratio double, sortino_ratio double, tax_efficiency double, score double"
)
PARENT_ATTRIBUTES = struct(f"cnpj_fundo string, cnpj_classe string, {_ATTRIBUTES}")
CHILD_ATTRIBUTES = struct(f"codigo_cvm_subclasse string, cnpj_fundo string, cnpj_classe string, {_ATTRIBUTES}")
ATTRIBUTE_COLUMNS = [f.name for f in struct(_ATTRIBUTES).fields]
SERIES_ROWS = struct("data date, valor double")
MANIFEST = struct(
    "source string, url string, competence string, etag string, last_modified string, sha256 string, "
    "byte_size bigint, row_count bigint, ingested_at timestamp, status string"
)
