"""Column resolution, canonical projection and row predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import label_is


def find_column(df: DataFrame, *candidates: str) -> str | None:
    """First candidate present in ``df``, compared trimmed and without case."""
    by_name = {c.strip().lower(): c for c in df.columns}
    return next((by_name[n] for n in (c.strip().lower() for c in candidates) if n in by_name), None)


def column_or_null(df: DataFrame, candidates: Sequence[str], alias: str, dtype: str = "string") -> Column:
    found = find_column(df, *candidates)
    source = F.col(f"`{found}`") if found else F.lit(None)
    return source.cast(dtype).alias(alias)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Fixed column order and types; absent columns are added as nulls."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """Stand-in for a missing source: joins against it leave all nulls."""
    return spark.createDataFrame([], schema)


def stack_relaxed(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by name; absent columns become null."""
    head, *rest = list(frames)
    for frame in rest:
        head = head.unionByName(frame, allowMissingColumns=True)
    return head


def on_or_before(df: DataFrame, date_col: str, as_of: date) -> DataFrame:
    """Point-in-time cutoff; rows without a date drop out."""
    return df.filter(F.col(date_col) <= F.lit(as_of))


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose label starts with ``prefix``, case-sensitive."""
    return df.filter(F.col(column).cast("string").startswith(prefix))


def with_label(df: DataFrame, column: str | None, wanted: str) -> DataFrame:
    """Rows whose trimmed, lower-cased label equals ``wanted``; no column, no filter."""
    return df if column is None else df.filter(label_is(F.col(f"`{column}`"), wanted))


def among(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*allowed))


def complete_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.filter(F.col(left).isNotNull() & F.col(right).isNotNull())


def missing_keys(expected: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys that were not seen."""
    return expected.join(seen, list(keys), "left_anti")


def typed(df: DataFrame, casts: Mapping[str, Column]) -> DataFrame:
    """Replace raw columns by parsed ones in a single projection."""
    return df.select(*[casts[c].alias(c) if c in casts else F.col(c) for c in df.columns])
