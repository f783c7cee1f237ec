"""Non-strict parsing: a bad value becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that stand for a missing value in delimited sources (fixed values).
NULL_TOKENS = ("", "N/A", "NA")

# Spark's own string casts forgive blanks and Java suffixes ("1d"); these do not.
_DECIMAL = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"
_INTEGER = r"^[+-]?\d+$"


# Forms that most values have.  They are told at once, without the back-tracking of the general patterns; possessive, so
# that other values fail fast.  For them a cast gives what the general way does.
_PLAIN = r"^-?\d++(?:\.\d++)?+$"
_PLAIN_DATE = r"^(?!0000)\d{4}-\d\d?-\d\d?\z"


def to_double(c: Column) -> Column:
    return F.when(c.rlike(_PLAIN) | c.rlike(_DECIMAL), c.try_cast("double"))


def to_long(c: Column) -> Column:
    """Whole numbers only: ``'10.0'`` is null."""
    return F.when(c.rlike(_INTEGER), c.try_cast("bigint"))


def iso_date(c: Column) -> Column:
    return F.when(c.rlike(_PLAIN_DATE), c.try_cast("date")).otherwise(F.try_to_date(c, "yyyy-M-d"))


def dmy_date(c: Column) -> Column:
    return F.try_to_date(c, "d/M/yyyy")


def null_tokens(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def percent(c: Column) -> Column:
    return c / F.lit(100.0)
