"""Rows whose values do not fit their types, kept apart with column, value and reason."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions.casts import lost

Types = Mapping[str, T.DataType]

FAULTS = "array<struct<column_name: string, value: string, reason: string>>"


def fault(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """What is wrong with the column's value in the given type; NULL where it fits."""
    text = isinstance(df.schema[name].dataType, T.StringType)
    beyond = F.lit(f"out of the range of {kind.simpleString()}")
    reason = F.lit(f"not a {kind.simpleString()}")
    if not text:
        reason = beyond
    elif isinstance(kind, T.NumericType):
        reason = F.when(F.col(name).try_cast("double").isNotNull(), beyond).otherwise(reason)
    found = F.struct(
        F.lit(name).alias("column_name"),
        F.col(name).cast("string").alias("value"),
        reason.alias("reason"),
    )
    return F.when(lost(name, kind), found)


@dataclass(frozen=True)
class Sifted:
    """A staged table: ``rows`` are all its rows as they came, ``fitting`` those whose
    values all fit, in their types, and ``rejected`` the others as they came with
    ``faults``. ``values`` counts the faults; a row can have several."""

    rows: DataFrame
    fitting: DataFrame
    rejected: DataFrame
    values: int


def sift(df: DataFrame, types: Types, folder: str, name: str = "sifted") -> Sifted:
    """Tags the rows of ``df`` and stages them, fitting and rejected ones apart.

    ``df`` is read once; each result reads its own files only. Missing values fit.
    """
    faults = F.filter(
        F.array(*[fault(df, n, kind) for n, kind in types.items()]), lambda f: f.isNotNull()
    )
    # In a struct, so that no column of the table can clash with the tags.
    row = F.struct(*[F.col(f"`{n}`") for n in df.columns]).alias("row")
    seen = Observation()
    tagged = df.select(row, faults.cast(FAULTS).alias("faults")).observe(
        seen, F.coalesce(F.sum(F.size("faults")), F.lit(0)).cast("long").alias("values")
    )
    path = f"{folder}/{name}"
    tagged.select("*", (F.size("faults") > 0).alias("misfit")).write.partitionBy("misfit").parquet(
        path
    )
    schema = tagged.schema.add("misfit", "boolean")
    staged = df.sparkSession.read.schema(schema).parquet(path)
    columns = [F.col(f"row.`{n}`") for n in df.columns]
    typed = [
        F.col(f"row.`{n}`").try_cast(types[n]).alias(n) if n in types else F.col(f"row.`{n}`")
        for n in df.columns
    ]
    return Sifted(
        rows=staged.select(*columns),
        fitting=staged.filter(~F.col("misfit")).select(*typed),
        rejected=staged.filter("misfit").select(*columns, "faults"),
        values=seen.get["values"],
    )
