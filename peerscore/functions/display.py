"""Text forms used by the published top list; null renders as an empty string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale steps of a money amount (fixed values): threshold, divisor suffix.
MONEY_STEPS = ((1e9, "B"), (1e6, "M"), (1e3, "K"))
# Fractions are split after this many bits (a power of two), so that both parts times 100 are exact.
SPLIT = float(2**26)


def hundredths(c: Column, flags: str = "") -> Column:
    """Two decimals of the double as it is stored, ties to even.

    ``format_string`` alone rounds the shortest decimal that reads back as the double, half up: 2.675, stored as
    2.67499..., would end as 2.68.  From 2**53 on a double has no fraction.  ``flags`` (``,`` or ``+``) as there.
    """
    x = c.cast("double")
    size = F.abs(x)
    whole = F.floor(size)
    fraction = size - whole
    high = F.floor(fraction * SPLIT) / SPLIT
    down = F.floor(high * 100)
    above = (high * 100 - down - 0.5) + (fraction - high) * 100
    up = (above > 0) | ((above == 0) & (down % 2 == 1))
    cents = F.when(fraction < 0.001, 0).otherwise(down + F.when(up, 1).otherwise(0))
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("+" if "+" in flags else "")
    grouped = "%,d" if "," in flags else "%d"
    exact = F.format_string(f"%s{grouped}.%02d", sign, whole + F.floor(cents / 100), (cents % 100).cast("bigint"))
    return F.when(size < float(2**53), exact).otherwise(F.format_string(f"%{flags}.2f", x))


def money(c: Column, symbol: str = "R$") -> Column:
    """Scaled to the largest step it reaches; only amounts below all steps have their thousands grouped."""
    scaled, suffix = c, F.lit("")
    for step, name in reversed(MONEY_STEPS):
        reached = F.abs(c) >= step
        scaled, suffix = F.when(reached, c / step).otherwise(scaled), F.when(reached, name).otherwise(suffix)
    digits = F.replace(hundredths(scaled, ","), F.lit(","), F.when(suffix == "", ",").otherwise(""))
    return F.when(c.isNull(), "").otherwise(F.concat(F.lit(f"{symbol} "), digits, suffix))


def signed_percent(c: Column) -> Column:
    return F.when(c.isNull(), "").otherwise(F.concat(hundredths(c * 100, "+"), F.lit("%")))


def plain_percent(c: Column) -> Column:
    return F.when(c.isNull(), "").otherwise(F.concat(hundredths(c * 100), F.lit("%")))


def thousands(c: Column) -> Column:
    return F.when(c.isNull(), "").otherwise(F.format_string("%,d", c.cast("bigint")))


def two_decimals(c: Column) -> Column:
    return F.when(c.isNull(), "").otherwise(hundredths(c))


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def entity_label(parent_id: Column, child_id: Column) -> Column:
    """```parent``` alone, or ```parent` (sub `child`)`` for a child entity."""
    parent = F.concat(F.lit("`"), parent_id, F.lit("`"))
    child = F.concat(parent, F.lit(" (sub `"), child_id, F.lit("`)"))
    return F.when(child_id.isNull() | (child_id == ""), parent).otherwise(child)
