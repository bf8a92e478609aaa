"""Sinks. Each output is computed once: its row count is observed while it is written."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from shopledger.sources.versions import publish


def _counted(
    df: DataFrame, fmt: str, mode: str, partition_by: Sequence[str]
) -> tuple[DataFrameWriter, Observation]:
    seen = Observation()
    if partition_by:
        # Gathers each directory's rows; AQE splits the ones that are too big.
        df = df.hint("rebalance", *partition_by)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer, seen


def write_dataset(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    versioned: bool = False,
) -> int:
    """Writes ``df`` under ``path`` and returns how many rows it wrote.

    With ``versioned``, an overwrite is a new version beside the current one, which
    readers have until the new one is whole (see ``versions``); ``read_parquet`` and
    ``read_path`` find the current version.
    """

    def write(folder: str) -> int:
        writer, seen = _counted(df, fmt, mode, partition_by)
        writer.options(**(options or {})).save(folder)
        return seen.get["rows"]

    if not versioned:
        return write(path)
    if mode != "overwrite":
        raise ValueError("only an overwrite makes a new version")
    return publish(df.sparkSession, path, write)


# Marks tables whose location is all they know of their files, so that moving it is the
# whole switch to another version.
SWITCHED = "shopledger.switched"

TRACKED_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


def _shape(spark: SparkSession, name: str) -> list[tuple] | None:
    """Columns of a table made by ``_create``, None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    properties = {row["key"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if SWITCHED not in properties:
        return None
    columns = spark.catalog.listColumns(name)
    return [(c.name, c.dataType, c.isPartition) for c in columns]


def _create(
    spark: SparkSession, name: str, df: DataFrame, fmt: str, partition_by: Sequence[str], folder: str
) -> None:
    columns = df.schema.toDDL()
    parts = ", ".join(f"`{part}`" for part in partition_by)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING {fmt} "
        + (f"PARTITIONED BY ({parts}) " if parts else "")
        + f"LOCATION '{folder}' TBLPROPERTIES ('{SWITCHED}' = 'true')"
    )


def publish_table(
    df: DataFrame,
    path: str,
    database: str,
    table: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    keep: int = 2,
) -> int:
    """Writes ``df`` as external table ``database.table``; returns the row count.

    An overwrite writes a new version under ``path``, and then moves the table's location
    there in one change of the catalog. If the write fails, or the job is killed, the table
    and its files are as before; ``keep`` versions stay for readers that have begun. Only
    where columns, types or partitioning differ from the table's is it dropped and made
    anew, which is two changes. Partitions are found by their folders. Other modes write
    straight to the table.
    """
    spark, name = df.sparkSession, f"`{database}`.`{table}`"

    def write(folder: str) -> int:
        writer, seen = _counted(df, fmt, "errorifexists", partition_by)
        writer.save(folder)
        return seen.get["rows"]

    def switch(folder: str) -> None:
        plain = [(f.name, f.dataType.simpleString(), f.name in partition_by) for f in df.schema]
        # Partition columns come last in a table.
        wanted = sorted(plain, key=lambda column: column[2])
        if _shape(spark, name) == wanted:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        else:
            before = spark.conf.get(TRACKED_PARTITIONS, None)
            spark.conf.set(TRACKED_PARTITIONS, "false")
            try:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
                _create(spark, name, df, fmt, partition_by, folder)
            finally:
                if before is None:
                    spark.conf.unset(TRACKED_PARTITIONS)
                else:
                    spark.conf.set(TRACKED_PARTITIONS, before)
        spark.catalog.refreshTable(name)

    if mode == "overwrite":
        return publish(spark, path, write, switch=switch, keep=keep)
    writer, seen = _counted(df, fmt, mode, partition_by)
    if not spark.catalog.tableExists(name):
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return seen.get["rows"]


def write_datasets(
    outputs: Mapping[str, DataFrame],
    root: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    parallel: int = 4,
    versioned: bool = False,
) -> dict[str, int]:
    """Writes every DataFrame to ``root/<name>``; returns the row counts by name."""

    def write(name: str) -> int:
        path = f"{root}/{name}"
        return write_dataset(outputs[name], path, fmt=fmt, mode=mode, versioned=versioned)

    return side_by_side(write, list(outputs), parallel)


def side_by_side(
    write: Callable[[str], int], names: Sequence[str], parallel: int = 4
) -> dict[str, int]:
    """``write(name)`` for every name, a few at a time.

    The last tasks of one output then leave no executors idle that another
    output could use. The first error is raised once running writes have ended.
    """
    with ThreadPoolExecutor(parallel) as pool:
        running = {name: pool.submit(write, name) for name in names}
        try:
            return {name: job.result() for name, job in running.items()}
        finally:
            pool.shutdown(cancel_futures=True)
