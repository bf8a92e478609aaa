"""Row counts and missing keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.casts import Types, lost


class RejectedValuesError(ValueError):
    """More values than accepted did not fit the type of their column."""


class DataQualityError(ValueError):
    """A table is empty or has rows without a key."""


def _measures(df: DataFrame, key_column: str | None) -> DataFrame:
    """Rows and missing keys, by plain counts, which file footers can answer.

    Counts from footers are sums over files, which are NULL where there is no row, although
    Catalyst takes them for counts and would drop a coalesce.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count(key_column) if key_column else F.count(F.lit(1))).alias("keys"),
    )
    some, zero = F.col("n") > 0, F.lit(0).cast("long")
    return counts.select(
        F.when(some, F.col("n")).otherwise(zero).alias("row_count"),
        F.when(some, F.col("n") - F.col("keys")).otherwise(zero).alias("null_keys"),
    )


def validate_data_quality(df: DataFrame, table_name: str, key_column: str | None = None) -> int:
    """The row count; raises if there are no rows or any key is NULL. One scan."""
    found = _measures(df, key_column).first()
    if found.row_count == 0:
        raise DataQualityError(f"{table_name} has no rows")
    if found.null_keys > 0:
        raise DataQualityError(f"{table_name} has {found.null_keys} NULLs in {key_column}")
    return found.row_count


def data_quality_report(tables: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """The same checks over many tables, as one lazy row per table.

    ``tables`` maps a name to (DataFrame, key column or None).
    """
    rows = [
        _measures(df, key).select(
            F.lit(name).alias("table_name"),
            F.lit(key).cast("string").alias("key_column"),
            "row_count",
            "null_keys",
            ((F.col("row_count") > 0) & (F.col("null_keys") == 0)).alias("passed"),
        )
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def rejected_values(df: DataFrame, types: Types) -> DataFrame:
    """(column_name, rejected): per column, how many values do not fit its type.

    One scan, one row per column of ``types``. Missing values are not rejected ones.
    """
    counts = df.agg(*[F.count_if(lost(name, kind)).alias(name) for name, kind in types.items()])
    rows = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("rejected")) for n in types]
    )
    return counts.select(F.inline(rows))
