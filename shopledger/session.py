"""Session settings the plans rely on."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Must be set when the application starts. Above 2,000 reducers Spark reports only
# average block sizes, which hides a hot key from AQE. With this factor blocks far
# above the median are reported as they are.
LAUNCH_SETTINGS = {"spark.shuffle.accurateBlockSkewedFactor": "5.0"}

# AQE and its skew-join splitting are on by default, but it leaves a skewed join
# alone when splitting would cost one more shuffle, as it does when an aggregate
# on the join key follows. A hot key is worth that shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Counts come from Parquet footers where the table is read for that (read_footers).
    "spark.sql.parquet.aggregatePushdown": "true",
}

GB = 1 << 30

# Spark's estimate for what it cannot measure is the largest long.
UNKNOWN_BYTES = 1 << 60

REDUCERS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLITS = "spark.sql.files.maxPartitionBytes"


def sized_for(
    input_bytes: int, *, bytes_per_reducer: int = GB, least_reducers: int = 200, splits: int = 200_000
) -> dict[str, str]:
    """Scan and shuffle sizes for an input of about ``input_bytes``.

    One reducer per ``bytes_per_reducer`` read: after column pruning and partial
    aggregation a GB is some 100 to 300 MB of shuffled data, and AQE merges what turns
    out smaller. There is no upper limit; on very large inputs raise
    ``bytes_per_reducer`` if the driver cannot keep the map statuses. A split has 128 MB,
    or as much more as keeps a scan at ``splits`` tasks.
    """
    reducers = max(least_reducers, -(-input_bytes // bytes_per_reducer))
    split = max(128 << 20, -(-input_bytes // splits))
    return {REDUCERS: str(reducers), SPLITS: str(split)}


def input_bytes_of(tables: Iterable[DataFrame]) -> int | None:
    """The size of the scans under the tables, by their statistics.

    Only scans are asked: the estimate of a join is a product. A scan of unknown size
    counts nothing; None if no size is known.
    """
    known = []
    for table in tables:
        try:
            leaves = table._jdf.queryExecution().optimizedPlan().collectLeaves()
        except AttributeError:  # a session without a JVM at hand
            return None
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        known += [size for size in sizes if size < UNKNOWN_BYTES]
    return sum(known) if known else None


@contextmanager
def sized(spark: SparkSession, input_bytes: int | None) -> Iterator[None]:
    """The sizes for ``input_bytes`` while the block runs; the session's own afterwards."""
    sizes = {} if input_bytes is None else sized_for(input_bytes)
    before = {name: spark.conf.get(name, None) for name in sizes}
    if int(sizes.get(REDUCERS, 0)) > 2000:
        for name in LAUNCH_SETTINGS:
            if spark.conf.get(name, None) is None:
                warnings.warn(f"{name} is not set: hot keys can go unseen", stacklevel=3)
    try:
        for name, value in sizes.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Applies the runtime settings to a session and returns it."""
    sizes = {} if input_bytes is None else sized_for(input_bytes)
    for name, value in (RUNTIME_SETTINGS | sizes).items():
        spark.conf.set(name, value)
    return spark


def new_session(app_name: str, input_bytes: int | None = None) -> SparkSession:
    """A session for the jobs; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in LAUNCH_SETTINGS.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate(), input_bytes)
