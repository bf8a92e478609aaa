"""Prints what a query shuffles, by Spark's event log; tables up to 200 KB are broadcast.

usage: python -m tools.shuffled sf_dir query ...
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile

from pyspark.sql import SparkSession

from shopledger.queries.registry import QUERIES


def shuffled(folder: str, name: str) -> tuple[int, int]:
    """(rows, bytes) that the query's tasks write for shuffles."""
    log = tempfile.mkdtemp(prefix="events-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.autoBroadcastJoinThreshold", "200KB")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "200KB")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    spark.stop()
    rows = size = 0
    for path in glob.glob(f"{log}/*/events_*"):
        for line in open(path):
            metrics = json.loads(line).get("Task Metrics") or {}
            written = metrics.get("Shuffle Write Metrics") or {}
            rows += written.get("Shuffle Records Written", 0)
            size += written.get("Shuffle Bytes Written", 0)
    return rows, size


if __name__ == "__main__":
    for query in sys.argv[2:]:
        records, written = shuffled(sys.argv[1], query)
        print(f"{query}: {records} rows, {written / 1e6:.1f} MB")
