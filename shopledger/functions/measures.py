"""Percentages, exact up to one rounding to two places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL where ``whole`` is 0 or NULL.

    Both are whole numbers, so the one division is the only place where anything is
    rounded before the result is.
    """
    base = F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round((F.lit(100) * part).cast("double") / base, 2)


def growth_pct(current: Column, previous: Column) -> Column:
    """Change from ``previous`` to ``current`` in percent, ties away from zero.

    Amounts in cents are made whole numbers of cents while they are decimals. Up to
    2**53 cents they are exact as doubles, so is a quotient that ends in half a
    hundredth, and rounding sees the true tie. NULL where there is no previous value
    or it is 0.
    """
    change = (F.lit(10_000) * (current - previous)).cast("double")
    base = F.nullif((F.lit(100) * previous).cast("double"), F.lit(0.0))
    return F.round(change / base, 2)


def numeric(df: DataFrame, name: str) -> Column:
    """``name`` as a number; text (a CSV source) is parsed, junk becomes NULL."""
    if isinstance(df.select(name).schema[0].dataType, T.StringType):
        return F.col(name).try_cast("double")
    return F.col(name)
