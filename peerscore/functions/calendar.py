"""Calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def days_since(start: Column, as_of: date) -> Column:
    """Whole days from ``start`` to ``as_of``, never below zero; null stays null."""
    days = F.datediff(F.lit(as_of), start).cast("bigint")
    return F.when(days < 0, F.lit(0).cast("bigint")).otherwise(days)
