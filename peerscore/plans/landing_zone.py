"""The landing zone as frames: which archives, files and years a run reads.

Payloads lie at ``{root}/{source}[/competence=KEY]/raw.{ext}``, or under the
file name they were dropped with.  A payload counts only once the manifest
knows its hash, so a half-landed file stays out of every table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.select import empty_frame
from ..schemas import struct
from ..session import materialise
from ..sources.archives import read_archives
from ..sources.delimited import read_delimited
from ..sources.landing import lookback_bounds, month_spine, resolve_keys, with_manifest, years_to_backfill
from ..sources.series import level_rows, read_json_series
from .settings import LEVEL_FILE_STEMS, RATE_SOURCES, SERIES_LOOKBACK_MONTHS

# Sources of the landing zone (fixed values).
REGISTRY = "cvm_registro_classe"
HISTORY = "cvm_cad_fi_hist"
DAILY = "cvm_inf_diario"
LEGACY_DAILY = "cvm_inf_diario_hist"
LEVELS = "anbima_indices"
PRODUCTS = "anbima_175"

# Members of the registry and history archives with the fields read from them (fixed values).
_STATUS = ["Denominacao_Social", "Situacao", "Data_Inicio_Situacao", "Exclusivo", "Publico_Alvo", "Forma_Condominio"]
MEMBERS = {
    "classes": (REGISTRY, "registro_classe.csv", ["ID_Registro_Classe", "ID_Registro_Fundo", "CNPJ_Classe", *_STATUS]),
    "funds": (REGISTRY, "registro_fundo.csv", ["ID_Registro_Fundo", "CNPJ_Fundo", "Denominacao_Social"]),
    "subclasses": (REGISTRY, "registro_subclasse.csv", ["ID_Registro_Classe", "ID_Subclasse", *_STATUS]),
    "admin_fees": (HISTORY, "cad_fi_hist_taxa_adm.csv", ["CNPJ_FUNDO", "DT_INI_TAXA_ADM", "TAXA_ADM"]),
    "performance_fees": (HISTORY, "cad_fi_hist_taxa_perfm.csv", ["CNPJ_FUNDO", "DT_INI_TAXA_PERFM", "VL_TAXA_PERFM"]),
    "benchmarks": (HISTORY, "cad_fi_hist_rentab.csv", ["CNPJ_Fundo", "DT_INI_RENTAB", "RENTAB_FUNDO"]),
}
LINE_COLUMN = "line_no"


def partitions(spark: SparkSession, root: str) -> DataFrame:
    """``(source, competence, name, path)`` of every payload below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    return files.select(
        F.regexp_extract("path", r"/([^/]+)(/competence=[^/]+)?/[^/]+$", 1).alias("source"),
        F.nullif(F.regexp_extract("path", r"/competence=([^/]+)/[^/]+$", 1), F.lit("")).alias("competence"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "path",
    )


@dataclass(frozen=True)
class Zone:
    """A landing zone and the manifest that says what of it has fully landed."""

    spark: SparkSession
    root: str
    manifest: DataFrame

    @cached_property
    def listing(self) -> DataFrame:
        """What lay in the zone when it was first asked for: listed once, written, and filtered by every source."""
        return materialise(partitions(self.spark, self.root), "landing-zone")

    def known(self, source: str) -> DataFrame:
        return with_manifest(self.listing.filter(F.col("source") == source), self.manifest, source)

    def paths(self, source: str) -> list[str]:
        """Known payloads of a source in order."""
        return [r["path"] for r in self.known(source).select("path").orderBy("path").collect()]


def member(zone: Zone, name: str) -> DataFrame:
    """Rows of a registry or history member; without a known archive, or without the member, none."""
    source, inside, fields = MEMBERS[name]
    paths = zone.paths(source)
    if not paths:
        return empty_frame(zone.spark, struct(", ".join(f"{c} string" for c in fields) + f", {LINE_COLUMN} long"))
    return read_archives(zone.spark, paths, fields, member=inside).select(*fields, LINE_COLUMN)


def daily_archives(zone: Zone, as_of: date, months: int = SERIES_LOOKBACK_MONTHS) -> tuple[list[str], list[str]]:
    """Monthly archives up to ``as_of``, and yearly ones of the years in which a month of the look-back is missing."""
    monthly = zone.known(DAILY).withColumn("month", F.try_to_date("competence", "yyyyMM")).filter(F.col("month") <= F.lit(as_of))
    years = years_to_backfill(month_spine(lookback_bounds(zone.spark, as_of, months)), monthly)
    yearly = zone.known(LEGACY_DAILY).withColumn("year", F.col("competence").try_cast("int")).join(years, "year", "left_semi")
    return tuple([r["path"] for r in rows.select("path").orderBy("path").collect()] for rows in (monthly, yearly))


def level_series(zone: Zone) -> dict[str, DataFrame]:
    """Series of the level files by column, whatever the case and extension of their names."""
    files = zone.known(LEVELS).select("name", "path")
    expected = zone.spark.createDataFrame(list(LEVEL_FILE_STEMS.items()), "stem string, key string")
    found = resolve_keys(files, expected, "name").filter("state = 'resolved'").join(files, "name").select("key", "path")
    return {r["key"]: level_rows(read_delimited(zone.spark, r["path"])) for r in found.orderBy("key", "path").collect()}


def rate_series(zone: Zone) -> dict[str, DataFrame]:
    paths = {code: zone.paths(source) for code, source in RATE_SOURCES.items()}
    return {code: read_json_series(zone.spark, found) for code, found in paths.items() if found}


def products(zone: Zone) -> DataFrame | None:
    """Rows of the product drop in their order, if there is one."""
    paths = zone.paths(PRODUCTS)
    return read_delimited(zone.spark, paths, keep_order=True) if paths else None
