"""Landing zone: manifest table, change detection, coverage and file names."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_stem
from ..schemas import MANIFEST

KEYS = ["source", "competence"]


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, hash and size of every payload below ``root/{source}[/competence=..]``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "raw.*")
        .load(root)
    )
    return files.select(
        F.regexp_extract("path", r"/([^/]+)(/competence=[^/]+)?/raw\.[^/]+$", 1).alias("source"),
        F.nullif(F.regexp_extract("path", r"/competence=([^/]+)/raw\.[^/]+$", 1), F.lit("")).alias("competence"),
        "path",
        F.sha2("content", 256).alias("sha256"),
        F.col("length").alias("byte_size"),
    )


def _status(landed: Column, prior: Column) -> Column:
    return (
        F.when(landed.isNull(), "not_found").when(landed == prior, "not_modified").otherwise("fetched")
    )


def classify_changes(
    landed: DataFrame, manifest: DataFrame, run_at: datetime, expected: DataFrame | None = None
) -> DataFrame:
    """New manifest: one row per landed or known key, with its status.

    A key that is only known, or only expected, is ``not_found``; an equal hash
    is ``not_modified``; anything else is ``fetched``.  The run time is
    refreshed on every row.  Snapshots have a null competence, so keys are
    compared null-safe through a struct.
    """
    key = F.struct(*KEYS).alias("_key")
    new = landed.select(key, F.col("sha256").alias("new_sha"), F.col("byte_size").alias("new_size"), F.col("path").alias("new_url"))
    old = manifest.select(key, *[c for c in manifest.columns if c not in (*KEYS, "ingested_at", "status")])
    # Struct equality treats null fields as equal, plain column equality does not.
    joined = new.join(old, "_key", "full_outer")
    if expected is not None:
        joined = joined.join(expected.select(key).distinct(), "_key", "full_outer")
    fresh = F.col("new_sha").isNotNull() & ~F.col("new_sha").eqNullSafe(F.col("sha256"))

    def pick(new_value: Column, old_value: str) -> Column:
        return F.when(fresh, new_value).otherwise(F.col(old_value)).alias(old_value)

    return joined.select(
        F.col("_key.source").alias("source"),
        pick(F.col("new_url"), "url"),
        F.col("_key.competence").alias("competence"),
        pick(F.lit(None).cast("string"), "etag"),
        pick(F.lit(None).cast("string"), "last_modified"),
        pick(F.col("new_sha"), "sha256"),
        pick(F.col("new_size"), "byte_size"),
        pick(F.lit(None).cast("bigint"), "row_count"),
        F.lit(run_at).cast("timestamp").alias("ingested_at"),
        _status(F.col("new_sha"), F.col("sha256")).alias("status"),
    ).select(*MANIFEST.fieldNames())


def with_manifest(partitions: DataFrame, manifest: DataFrame, source: str) -> DataFrame:
    """Rows of those ``competence`` partitions that have a manifest entry; a snapshot's competence is null."""
    known = manifest.filter((F.col("source") == source) & F.col("sha256").isNotNull()).select(
        F.col("competence").alias("_known")
    )
    return partitions.join(known, F.col("competence").eqNullSafe(F.col("_known")), "left_semi")


def month_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every month between two dates, both included; an inverted range gives none.

    Further columns of ``bounds`` are kept.
    """
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    months = F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    rest = [c for c in bounds.columns if c not in (start, end)]
    return bounds.filter(first <= last).select(*rest, F.explode(months).alias("month"))


def _is_leap(year: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(year, F.lit(2), F.lit(1)))) == 29


def year_windows(bounds: DataFrame, years: int, start: str = "start", end: str = "end") -> DataFrame:
    """Inclusive, non-overlapping windows of up to ``years`` years.

    A start on 29 February moves to the 28th at the first window whose year
    has no such day, and stays there.  Further columns of ``bounds`` are kept.
    """
    ini, fim = F.col(start), F.col(end)
    rest = [c for c in bounds.columns if c not in (start, end)]
    starts = F.sequence(F.lit(0), F.floor((F.year(fim) - F.year(ini)) / years).cast("int") + 1)
    out = bounds.filter(ini <= fim).select(*rest, ini.alias("_ini"), fim.alias("_fim"), F.explode(starts).alias("_k"))
    leap_day = (F.month("_ini") == 2) & (F.dayofmonth("_ini") == 29)

    def opening(k: Column) -> Column:
        plain = F.add_months("_ini", k * 12 * years)
        drifted = F.exists(
            F.when(k >= 1, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>")),
            lambda j: ~_is_leap(F.year("_ini") + j * years),
        )
        return F.when(leap_day & drifted, F.make_date(F.year(plain), F.lit(2), F.lit(28))).otherwise(plain)

    k = F.col("_k")
    return out.select(
        *rest,
        opening(k).alias("window_start"),
        F.least(F.date_sub(opening(k + 1), 1), F.col("_fim")).alias("window_end"),
        "_fim",
    ).filter(F.col("window_start") <= F.col("_fim")).drop("_fim")


def lookback_bounds(spark: SparkSession, as_of: date, months: int) -> DataFrame:
    """First day of the month ``months - 1`` before ``as_of``, to the month of ``as_of``."""
    day = F.lit(as_of)
    return spark.range(1).select(
        F.trunc(F.add_months(day, -(months - 1)), "month").alias("start"), F.trunc(day, "month").alias("end")
    )


def years_to_backfill(spine: DataFrame, landed_months: DataFrame) -> DataFrame:
    """Years in which at least one month of the spine has not landed."""
    return spine.join(landed_months.select("month"), "month", "left_anti").select(F.year("month").alias("year")).distinct()


def resolve_keys(files: DataFrame, expected: DataFrame, name: str = "name") -> DataFrame:
    """Files and expected keys side by side: resolved, unknown or missing.

    ``expected`` holds ``(stem, key)`` with lower-case stems.
    """
    seen = files.select(name, file_stem(F.col(name)).alias("stem"))
    # Left join plus anti join instead of a full outer join: a stem shared by
    # very many files can then be split over tasks.
    found = seen.join(expected, "stem", "left").select(
        name, "stem", "key", F.when(F.col("key").isNull(), "unknown").otherwise("resolved").alias("state")
    )
    absent = expected.join(seen, "stem", "left_anti").select(
        F.lit(None).cast("string").alias(name), "stem", "key", F.lit("missing").alias("state")
    )
    return found.unionByName(absent)
