"""The daily series stored by entity: metrics, anchors and attributes of later runs start without an exchange."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators.match import entity_key
from ..sources.tables import read_by_key, write_by_key

TABLE = "quota_series_by_entity"
KEY, ORDER = "fund_key", ("dt_comptc",)


def write_entity_series(series: DataFrame, root: str, as_of: date, buckets: int | None = None) -> str:
    """Publish the canonical series with its ``fund_key``, in buckets of it; rows without an entity stay, under a null key.

    The series has one row per entity and day, so the calendar bounds what one
    entity puts into its bucket.
    """
    return write_by_key(series.withColumn(KEY, entity_key()), root, "silver", TABLE, as_of, KEY, ORDER, buckets)


def read_entity_series(spark: SparkSession, root: str, as_of: date) -> DataFrame:
    return read_by_key(spark, root, "silver", TABLE, as_of, KEY, ORDER)
