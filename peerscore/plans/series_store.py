"""The canonical daily series kept up to date: a corrected archive rewrites the months it touches, no others.

The store holds the series by month, and beside it which archive has lines of
which month, whether they won or not.  A corrected archive touches the months
of its new lines and those it had lines of before.  These months are built anew
from all archives with lines in them, so the result is that of a full build,
and replaced by a dynamic partition overwrite.  The coverage is replaced last:
an update that is lost half way is repeated as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..operators.dedup import keep_first
from ..operators.select import on_or_before
from ..schemas import QUOTA_SERIES
from ..session import materialise, remove
from ..sources.archives import LINE_ORDER
from ..sources.tables import read_table, write_table
from .daily_series import SERIES_KEY, unify_eras

#: Files of a month: a month's rows are spread over as many tasks.
FILES = 8
_LAYER, _COVERAGE = "series_store", "coverage"
#: The coverage has one state, whatever date the series goes up to.
_STATE = date(1970, 1, 1)

ReadArchives = Callable[[Sequence[str]], DataFrame]


def changed_archives(manifest: DataFrame, sources: Sequence[str]) -> list[str]:
    """Payloads of daily sources whose content is new in a manifest of ``sources.landing.classify_changes``."""
    fresh = manifest.filter(F.col("source").isin(list(sources)) & (F.col("status") == "fetched"))
    return [r["url"] for r in fresh.select("url").orderBy("url").toLocalIterator()]


def series_path(root: str) -> str:
    return f"{root.rstrip('/')}/{_LAYER}/by_month"


def _typed(lines: DataFrame, as_of: date) -> DataFrame:
    return on_or_before(unify_eras(lines), "dt_comptc", as_of).withColumn("month", F.trunc("dt_comptc", "month"))


def _write_months(rows: DataFrame, root: str) -> None:
    kept = keep_first(rows, SERIES_KEY, list(LINE_ORDER)).select(*QUOTA_SERIES.fieldNames(), "month")
    spread = F.pmod(F.hash("cnpj_fundo_classe"), F.lit(FILES))
    (
        kept.repartition("month", spread)
        .sortWithinPartitions("month", "dt_comptc")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(series_path(root))
    )


def _coverage(typed: DataFrame) -> DataFrame:
    return typed.select("path", "month").distinct()


def build(spark: SparkSession, root: str, read: ReadArchives, archives: Sequence[str], as_of: date) -> None:
    """The store from nothing."""
    update(spark, root, read, archives, as_of, known=spark.createDataFrame([], "path string, month date"))


def update(
    spark: SparkSession, root: str, read: ReadArchives, changed: Sequence[str], as_of: date,
    removed: Sequence[str] = (), known: DataFrame | None = None,
) -> list[date]:
    """Take in corrected, new and removed archives; returns the months that were rewritten.

    ``read`` gives the lines of archives as they are now.  Names of archives and
    months, one for each, come to the driver; rows do not.
    """
    if known is None:
        known = read_table(spark, root, _LAYER, _COVERAGE, _STATE)
    gone = spark.createDataFrame([(p,) for p in {*changed, *removed}], "path string")
    new = materialise(_coverage(_typed(read(list(changed)), as_of)), "series-coverage") if changed else known.limit(0)
    before = known.join(gone, "path", "left_semi")
    months = sorted(r["month"] for r in new.unionByName(before).select("month").distinct().toLocalIterator())
    if not months:
        return []
    covered = materialise(known.join(gone, "path", "left_anti").unionByName(new), "series-coverage")
    touched = covered.filter(F.col("month").isin(months))
    archives = [r["path"] for r in touched.select("path").distinct().orderBy("path").toLocalIterator()]
    if archives:
        _write_months(_typed(read(archives), as_of).filter(F.col("month").isin(months)), root)
    left = {r["month"] for r in touched.select("month").distinct().toLocalIterator()}
    remove(spark, [f"{series_path(root)}/month={m.isoformat()}" for m in months if m not in left])
    write_table(covered, root, _LAYER, _COVERAGE, _STATE)
    return months


def read_series(spark: SparkSession, root: str) -> DataFrame:
    """The series as of the last update; filters on ``month`` read its folders only."""
    schema = StructType([*QUOTA_SERIES.fields, StructField("month", DateType())])
    return spark.read.schema(schema).parquet(series_path(root))
