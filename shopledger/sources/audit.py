"""One log of job runs, kept apart from the data the jobs overwrite.

A run has an id. The same run may be logged again, by a retry of its job or by tidying, and
counts once: the latest row of an id stands. So rows are only ever appended, and files of
many runs can be merged by writing their rows again before the old files go.
"""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopledger.sources.staging import file_system

AUDIT_SCHEMA = (
    "job_name string, status string, record_count bigint, "
    "start_time timestamp, end_time timestamp, log_ts timestamp"
)

RUN = "run_id string"

# Above so many files the log is merged into one.
MOST_FILES = 100


def write_audit_log(
    spark: SparkSession,
    path: str,
    job_name: str,
    status: str,
    record_count: int,
    start_time: datetime,
    end_time: datetime,
    run_id: str | None = None,
) -> None:
    """Appends one run to the log at ``path``; without ``run_id`` as a run of its own."""
    run = (job_name, status, record_count, start_time, end_time, datetime.now())
    row = spark.createDataFrame([(*run, run_id or uuid4().hex)], f"{AUDIT_SCHEMA}, {RUN}")
    row.coalesce(1).write.mode("append").parquet(path)
    merge_audit_log(spark, path)


def _rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The latest row of each run; rows from before there were run ids each count."""
    rows = spark.read.schema(f"{AUDIT_SCHEMA}, {RUN}").parquet(*paths)
    own = F.coalesce("run_id", F.uuid())
    latest = Window.partitionBy("own").orderBy(F.desc("log_ts"), F.desc("end_time"), "status")
    return (
        rows.withColumn("own", own)
        .withColumn("place", F.row_number().over(latest))
        .filter("place = 1")
        .drop("own", "place")
    )


def read_audit_log(spark: SparkSession, path: str, *, run_ids: bool = False) -> DataFrame:
    """All runs in the log, oldest first; with ``run_ids`` their ids too."""
    rows = _rows(spark, [path]).orderBy(F.col("log_ts"))
    return rows if run_ids else rows.drop("run_id")


def merge_audit_log(spark: SparkSession, path: str, most_files: int = MOST_FILES) -> None:
    """Merges the log's files into one if there are more than ``most_files``.

    Readers meanwhile see rows twice at most, which count once.
    """
    folder, files = file_system(spark, path)
    names = [status.getPath().toString() for status in files.listStatus(folder)]
    names = [name for name in names if name.endswith(".parquet")]
    if len(names) <= most_files:
        return
    _rows(spark, names).coalesce(1).write.mode("append").parquet(path)
    for name in names:
        old, _ = file_system(spark, name)
        files.delete(old, False)
