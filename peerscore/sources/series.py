"""Rate and level series scans: ``(data, valor)`` rows, one per date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import dmy_date, iso_date, to_double
from ..operators.dedup import keep_first
from ..operators.select import empty_frame
from ..schemas import SERIES_ROWS

# Field and column names the publishers use (fixed values).
LEVEL_DATE_COLUMN = "Data de Referência"
LEVEL_VALUE_COLUMN = "Número Índice"


def parse_rate_records(records: DataFrame, keys: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Text records ``(data d/m/Y, valor)`` to typed rows, one per key and date."""
    parsed = records.select(
        *keys,
        *order,
        dmy_date(F.col("data").cast("string")).alias("data"),
        to_double(F.col("valor").cast("string")).alias("valor"),
    ).filter(F.col("data").isNotNull())
    return keep_first(parsed, [*keys, "data"], [*order, "valor"]).select(*keys, "data", "valor")


def explode_record_arrays(df: DataFrame, column: str) -> DataFrame:
    """Rows holding a JSON array of records as text, to one row per record."""
    records = F.from_json(F.col(column), "array<struct<data: string, valor: string>>")
    return df.select(*[c for c in df.columns if c != column], F.inline(records))


def read_json_series(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON arrays of ``{"data": .., "valor": ..}``; overlapping chunks lose their repeats."""
    raw = (
        spark.read.schema("data string, valor string")
        .option("multiLine", True)
        .json(path)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    return parse_rate_records(raw, order=["file"])


def level_rows(drop: DataFrame) -> DataFrame:
    """The two needed columns of a level drop; without them, no rows."""
    if LEVEL_DATE_COLUMN not in drop.columns or LEVEL_VALUE_COLUMN not in drop.columns:
        return empty_frame(drop.sparkSession, SERIES_ROWS)
    kinds = dict(drop.dtypes)
    day, level = F.col(f"`{LEVEL_DATE_COLUMN}`"), F.col(f"`{LEVEL_VALUE_COLUMN}`")
    # Text is read as strictly as everywhere else; typed columns only change their type.
    typed = drop.select(
        (iso_date(day) if kinds[LEVEL_DATE_COLUMN] == "string" else day.try_cast("date")).alias("data"),
        (to_double(level) if kinds[LEVEL_VALUE_COLUMN] == "string" else level.try_cast("double")).alias("valor"),
    ).filter(F.col("data").isNotNull())
    return keep_first(typed, ["data"], ["valor"])
