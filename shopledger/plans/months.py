"""Monthly sales sums that are kept, and made anew only for months whose input changed.

Under one root lie the facts (``facts/origin=.../sales_month=...``), their sums per
customer, product and month (``months/sales_month=...``), and a list of which files of
facts each month's sums were made from. A refresh compares that list with the files there
are, which reads no fact, and sums the months that differ. A month's facts are replaced,
and its sums, by overwriting its folder alone.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions.casts import fitted
from shopledger.operators.sales import SALES_COLUMNS, fact_types
from shopledger.operators.trends import sales_by_month
from shopledger.sources.reading import read_parquet
from shopledger.sources.staging import file_system
from shopledger.sources.writing import write_dataset

FACTS, MONTHS, MADE_FROM, LIKE = "facts", "months", "made_from", "like"

MONTH = "sales_month"

# How Spark names the folder of a missing partition value.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def _month() -> Column:
    return F.trunc("order_date", "MM").alias(MONTH)


def _replace(df: DataFrame, path: str, parts: list[str]) -> None:
    """Overwrites the folders of ``path`` that ``df`` has rows for."""
    write_dataset(df, path, partition_by=parts, options={"partitionOverwriteMode": "dynamic"})


def _drop(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        path, files = file_system(spark, folder)
        files.delete(path, True)


def _folder(month: date | None) -> str:
    return f"{MONTH}={NO_MONTH if month is None else month.isoformat()}"


def store_facts(
    sales: DataFrame,
    root: str,
    *,
    origin: str = "current",
    first: date | None = None,
    last: date | None = None,
) -> list[date | None]:
    """Replaces the facts of one origin in the months that ``sales`` has; returns those.

    With ``first`` or ``last`` (any day of a month) ``sales`` is all there is from the one
    month to the other: stored months in between without a row now are dropped. Facts of
    several origins, such as current and historical sales, add up in a month. All facts
    under a root have the types of those stored first; what does not fit becomes NULL,
    which ``sources.sift`` finds before.
    """
    spark, path = sales.sparkSession, f"{root}/{FACTS}"
    like, files = file_system(spark, f"{root}/{LIKE}")
    if not files.exists(like):
        write_dataset(sales.select(*SALES_COLUMNS).limit(0), f"{root}/{LIKE}", versioned=True)
    seen = Observation()
    months = F.collect_set(F.coalesce(F.col(MONTH).cast("string"), F.lit(NO_MONTH)))
    dated = (
        sales.select(*fitted(fact_types(_like(spark, root))))
        .select(*SALES_COLUMNS, F.lit(origin).alias("origin"), _month())
        .observe(seen, months.alias("months"))
    )
    _replace(dated, path, ["origin", MONTH])
    found = set(seen.get["months"])
    if first is not None or last is not None:
        low = (first or date.min).replace(day=1).isoformat()
        high = (last or date.max).isoformat()
        folder, files = file_system(spark, f"{path}/origin={origin}")
        there = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        names = [name.split("=", 1)[1] for name in there if name.startswith(f"{MONTH}=")]
        gone = [n for n in names if n != NO_MONTH and low <= n <= high and n not in found]
        _drop(spark, [f"{path}/origin={origin}/{MONTH}={name}" for name in gone])
    dates = {None if name == NO_MONTH else date.fromisoformat(name) for name in found}
    return sorted(dates, key=lambda day: (day is not None, day))


def _files_by_month(spark: SparkSession, root: str) -> DataFrame:
    """(sales_month, made_from): per month a digest of its fact files. Reads no content."""
    named = F.concat_ws(
        "|",
        F.regexp_extract("path", r"origin=.*$", 0),
        "length",
        F.unix_micros("modificationTime"),
    )
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(f"{root}/{FACTS}")
        .select(
            F.regexp_extract("path", rf"{MONTH}=([^/]+)/", 1).alias(MONTH), named.alias("file")
        )
        .groupBy(MONTH)
        .agg(F.sha2(F.array_join(F.sort_array(F.collect_list("file")), "\n"), 256).alias(MADE_FROM))
    )


def refresh_months(spark: SparkSession, root: str) -> list[date | None]:
    """Sums the months whose facts changed since the last refresh; returns those.

    The list of what sums were made from is written last, so a run that fails is made up
    for by the next one. Only the months' names and digests reach the driver.
    """
    now = dict(map(tuple, _files_by_month(spark, root).collect()))
    listed, files = file_system(spark, f"{root}/{MADE_FROM}")
    before = (
        dict(map(tuple, read_parquet(spark, f"{root}/{MADE_FROM}").collect()))
        if files.exists(listed)
        else {}
    )
    changed = sorted(name for name in now if now[name] != before.get(name))
    days = [None if name == NO_MONTH else date.fromisoformat(name) for name in changed]
    if changed:
        wanted = F.col(MONTH).isin([day for day in days if day is not None])
        if None in days:
            wanted = wanted | F.col(MONTH).isNull()
        facts = _stored(spark, f"{root}/{FACTS}", _like(spark, root)).filter(wanted)
        sums = sales_by_month(facts.select(*SALES_COLUMNS))
        _replace(sums.withColumn(MONTH, F.col("order_date")), f"{root}/{MONTHS}", [MONTH])
    _drop(spark, [f"{root}/{MONTHS}/{MONTH}={name}" for name in before if name not in now])
    if now != before:
        state = spark.createDataFrame(sorted(now.items()), f"{MONTH} string, {MADE_FROM} string")
        write_dataset(state.coalesce(1), f"{root}/{MADE_FROM}", versioned=True)
    return days


def _like(spark: SparkSession, root: str) -> DataFrame:
    """No rows, with the types of the facts stored first."""
    return read_parquet(spark, f"{root}/{LIKE}")


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table by month with the columns of ``like``; asks no file for its schema."""
    schema = T.StructType([*like.schema, T.StructField(MONTH, T.DateType())])
    return spark.read.schema(schema).parquet(path)


def monthly_sales(spark: SparkSession, root: str) -> DataFrame:
    """The kept sums, with the columns of ``sales_by_month``."""
    sums = sales_by_month(_like(spark, root))
    return _stored(spark, f"{root}/{MONTHS}", sums).select(*sums.columns)
