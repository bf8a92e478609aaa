"""Scans: catalog tables, Parquet directories, any other format, local rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shopledger.sources.versions import current_folder

# A source gives the table of a name.
Source = Callable[[str], DataFrame]


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.read.table(f"{database}.{name}" if database else name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet directory; of a versioned one the current version."""
    return spark.read.parquet(current_folder(spark, path))


# Which formats Spark reads with its first file reader. The second one counts from footers.
V1_FORMATS = "spark.sql.sources.useV1SourceList"


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet directory whose rows and column values are counted from file footers.

    Counts without a filter or grouping then read no column, if the session has the
    setting of ``session.tune`` when they run; all else reads as usual.
    """
    before = spark.conf.get(V1_FORMATS)
    spark.conf.set(V1_FORMATS, ",".join(f for f in before.split(",") if f != "parquet"))
    try:
        return read_parquet(spark, path)
    finally:
        spark.conf.set(V1_FORMATS, before)


def read_path(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Any format Spark reads. By default CSV with a header, all columns text.

    Of a versioned dataset the current version is read. A schema spares an inference pass and types the columns; see also ``conform``. For CSV and JSON
    ``malformed`` names a column to add: the whole line where it has too few or too many
    fields, or one that is not of its type, and NULL elsewhere. That needs a schema, and all
    columns are parsed; Spark wants the result staged before the column is asked for alone.
    """
    reader = spark.read.format(fmt).options(**(options or {"header": "true"}))
    if malformed is not None:
        if schema is None:
            raise ValueError("malformed lines are told by a schema")
        if not isinstance(schema, T.StructType):
            schema = T.StructType.fromDDL(schema)
        schema = T.StructType([*schema, T.StructField(malformed, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", malformed).option("mode", "PERMISSIVE")
        reader = reader.option("columnPruning", "false")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(current_folder(spark, path))


def rows(spark: SparkSession, values: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table from driver-side rows, with a declared schema."""
    return spark.createDataFrame(list(values), schema)


def catalog_source(spark: SparkSession, database: str | None = None) -> Source:
    """Tables of one catalog database."""
    return lambda name: read_table(spark, name, database)


def directory_source(spark: SparkSession, root: str, fmt: str = "parquet") -> Source:
    """Tables stored as ``root/<name>``."""
    return lambda name: read_path(spark, f"{root}/{name}", fmt)
