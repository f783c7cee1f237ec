"""Typed entity dimensions: classes without subclasses, and subclasses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import iso_date, percent, to_double, to_long
from ..functions.text import clean_id, text_trim
from ..operators.dedup import keep_first, latest_record
from ..operators.impute import impute_with_mode, map_labels, mode_bounds
from ..operators.match import drop_parents_with_children, hierarchy_chain, star, two_pass_match
from ..operators.quality import Watch, unwatched
from ..operators.select import conform, empty_frame, find_column, with_prefix
from ..schemas import ATTRIBUTE_COLUMNS, CLASS_FUNDS, SUBCLASS_FUNDS, struct
from .settings import BENCHMARK_CODES, DEFAULT_BENCHMARK, FIXED_INCOME_PREFIX

FEES = ("taxa_adm", "taxa_perform")


def latest_attribute(
    history: DataFrame | None,
    spark,
    value: str,
    date: str,
    alias: str,
    as_percent: bool = False,
    as_text: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Most recent value per fund; a missing file or column gives no rows."""
    kind = "string" if as_text else "double"
    fund = find_column(history, "CNPJ_Fundo") if history is not None else None
    if fund is None or value not in history.columns or date not in history.columns:
        return empty_frame(spark, struct(f"cnpj_fundo string, {alias} {kind}"))
    parsed = F.col(value).cast("string") if as_text else to_double(F.col(value))
    if as_percent:
        parsed = percent(parsed)
    rows = history.select(
        clean_id(F.col(fund)).alias("cnpj_fundo"), iso_date(F.col(date)).alias("_since"), parsed.alias(alias), *order
    )
    return latest_record(rows, "cnpj_fundo", "_since", [*order, alias]).select("cnpj_fundo", alias)


def fee_and_benchmark_lookups(
    spark,
    adm: DataFrame | None,
    performance: DataFrame | None,
    rentability: DataFrame | None,
    order: Sequence[str] = (),
) -> list[tuple[DataFrame, list[str]]]:
    key = ["cnpj_fundo"]
    return [
        (latest_attribute(adm, spark, "TAXA_ADM", "DT_INI_TAXA_ADM", "taxa_adm", as_percent=True, order=order), key),
        (
            latest_attribute(
                performance, spark, "VL_TAXA_PERFM", "DT_INI_TAXA_PERFM", "taxa_perform", as_percent=True, order=order
            ),
            key,
        ),
        (
            latest_attribute(
                rentability, spark, "RENTAB_FUNDO", "DT_INI_RENTAB", "benchmark", as_text=True, order=order
            ),
            key,
        ),
    ]


def _status_columns(name_alias: str) -> list[Column]:
    return [
        text_trim(F.col("Denominacao_Social")).alias(name_alias),
        F.col("Situacao").alias("situacao"),
        iso_date(F.col("Data_Inicio_Situacao")).alias("data_de_inicio"),
        F.col("Exclusivo").alias("exclusivo"),
        F.col("Publico_Alvo").alias("publico_alvo"),
        F.col("Forma_Condominio").alias("condominio"),
    ]


def _registry_id(name: str) -> Column:
    return to_long(F.col(name).cast("string")).alias(name)


def class_dimension(
    classes: DataFrame,
    funds: DataFrame,
    subclasses: DataFrame,
    attributes: DataFrame,
    lookups: Sequence[tuple[DataFrame, Sequence[str]]],
    order: Sequence[str] = (),
    watch: Watch = unwatched,
) -> DataFrame:
    """One row per class that has no subclass."""
    keyed = watch(classes.withColumn("ID_Registro_Classe", _registry_id("ID_Registro_Classe")), "read")
    if "ID_Registro_Classe" in subclasses.columns:
        subclasses = subclasses.select(_registry_id("ID_Registro_Classe"))
    alone = watch(drop_parents_with_children(keyed, subclasses, "ID_Registro_Classe"), "without subclasses")
    base = alone.select(
        _registry_id("ID_Registro_Fundo"),
        clean_id(F.col("CNPJ_Classe")).alias("cnpj_classe"),
        *_status_columns("denom_social_classe"),
        *order,
    )
    fund = funds.select(
        _registry_id("ID_Registro_Fundo"),
        clean_id(F.col("CNPJ_Fundo")).alias("cnpj_fundo"),
        text_trim(F.col("Denominacao_Social")).alias("denom_social_fundo"),
        *order,
    )
    fund = keep_first(fund, ["ID_Registro_Fundo"], [*order, "cnpj_fundo", "denom_social_fundo"]).drop(*order)
    enriched = star(
        base, [(fund, ["ID_Registro_Fundo"]), (attributes, ["cnpj_fundo", "cnpj_classe"]), *lookups]
    )
    ranked = keep_first(enriched, ["cnpj_classe"], [*order, "cnpj_fundo", "denom_social_classe", "data_de_inicio"])
    return conform(watch(ranked, "one per class", "data_de_inicio"), CLASS_FUNDS)


def subclass_dimension(
    subclasses: DataFrame,
    classes: DataFrame,
    funds: DataFrame,
    attributes: DataFrame,
    lookups: Sequence[tuple[DataFrame, Sequence[str]]],
    order: Sequence[str] = (),
    watch: Watch = unwatched,
) -> DataFrame:
    """One row per subclass, with its class and fund ids and two-pass attributes."""
    sub = watch(subclasses, "read").select(
        _registry_id("ID_Registro_Classe"),
        F.col("ID_Subclasse").cast("string").alias("id_subclasse_cvm"),
        *_status_columns("denom_social_subclasse"),
        *[F.col(c).alias(f"_sub_{c}") for c in order],
    )
    cls = classes.select(
        _registry_id("ID_Registro_Classe"),
        _registry_id("ID_Registro_Fundo"),
        clean_id(F.col("CNPJ_Classe")).alias("cnpj_classe"),
        *order,
    )
    fund = funds.select(_registry_id("ID_Registro_Fundo"), clean_id(F.col("CNPJ_Fundo")).alias("cnpj_fundo"), *order)
    base = hierarchy_chain(sub, cls, fund, "ID_Registro_Classe", "ID_Registro_Fundo", order)
    matched = two_pass_match(
        base,
        attributes,
        "id_subclasse_cvm",
        "codigo_cvm_subclasse",
        ["cnpj_fundo", "cnpj_classe"],
        ATTRIBUTE_COLUMNS,
        [c for c in order if c in attributes.columns] or ATTRIBUTE_COLUMNS,
        watch,
    )
    enriched = star(matched, lookups)
    ranked = keep_first(
        enriched,
        ["id_subclasse_cvm"],
        [*[f"_sub_{c}" for c in order], "cnpj_classe", "denom_social_subclasse", "data_de_inicio"],
    )
    return conform(watch(ranked, "one per subclass", "data_de_inicio"), SUBCLASS_FUNDS)


def fixed_income(dim: DataFrame, watch: Watch = unwatched) -> DataFrame:
    return watch(with_prefix(watch(dim, "read"), "classificacao_anbima", FIXED_INCOME_PREFIX), "fixed income")


def treated(dim: DataFrame, stats_from: DataFrame | None = None, watch: Watch = unwatched) -> DataFrame:
    """Canonical benchmark codes and imputed fees.

    Fee statistics come from ``stats_from`` (the class table, for subclasses)
    or from the table itself.
    """
    stats = mode_bounds(dim if stats_from is None else stats_from, FEES)
    dim = watch(dim, "read", **{f"without_{c}": F.count_if(F.col(c).isNull()) for c in (*FEES, "benchmark")})
    return impute_with_mode(map_labels(dim, "benchmark", BENCHMARK_CODES, DEFAULT_BENCHMARK), FEES, stats)
