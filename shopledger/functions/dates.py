"""Report dates and trailing windows.

Every operator whose result depends on "today" takes ``as_of``. A literal date
keeps the comparison foldable, so Catalyst pushes it into the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AsOf = date | str | Column | None


def as_of_date(as_of: AsOf = None) -> Column:
    """The report date as a date column; the session's current date by default."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, str):
        as_of = date.fromisoformat(as_of)
    elif isinstance(as_of, datetime):
        as_of = as_of.date()
    return F.lit(as_of)


def dated(df: DataFrame, name: str) -> Column:
    """``name`` as a column that can be compared with dates.

    Dates and timestamps are passed through bare, which keeps the filter
    pushable. Text is parsed, and text that is no date becomes NULL.
    """
    if isinstance(df.select(name).schema[0].dataType, T.StringType):
        return F.col(name).try_cast("date")
    return F.col(name)


def month_column(name: str) -> str:
    """The column that holds the first day of a date column's month, if a table has it."""
    return f"{name}_month"


def with_month(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the month of ``name``, to be published by it."""
    return df.withColumn(month_column(name), F.trunc(dated(df, name), "MM"))


def in_trailing_days(df: DataFrame, name: str, as_of: AsOf, days: int) -> Column:
    """True where ``name`` is on or after the day ``days`` before ``as_of``.

    On a table published by month (see ``with_month``) it also compares the months, which
    for a literal ``as_of`` leaves the folders of older ones unread.
    """
    start = F.date_sub(as_of_date(as_of), days)
    recent = dated(df, name) >= start
    month = month_column(name)
    if month in df.columns and isinstance(df.schema[month].dataType, T.DateType):
        return (F.col(month) >= F.trunc(start, "MM")) & recent
    return recent
