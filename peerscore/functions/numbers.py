"""Guards around arithmetic that would error or give a non-finite value."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS_PER_YEAR = 12.0
SQRT_12 = math.sqrt(MONTHS_PER_YEAR)

# A spread at or below this share of the mean is rounding noise around a constant series.
SPREAD_FLOOR = 1e-12


def finite(c: Column) -> Column:
    """The value, or null when it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def spread_or_null(std: Column, mean: Column) -> Column:
    """A usable denominator: null unless clearly above zero, measured against the mean it is a spread around."""
    return F.when(std > F.lit(SPREAD_FLOOR) * F.abs(mean), std)


def below_zero(c: Column) -> Column:
    """The negative part: ``min(c, 0)``, null for null."""
    return F.when(c.isNotNull(), F.least(c, F.lit(0.0)))


def lookup(mapping: dict, key: Column, value_type: str) -> Column:
    """Literal dictionary lookup; unknown and null keys give null."""
    if not mapping:
        return F.lit(None).cast(value_type)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key).cast(value_type)
