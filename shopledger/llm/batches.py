"""Helpers for functions over Arrow batches, shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows are worked on in slices of about this much text, so that memory follows the
# longest text and not the number of rows Spark puts into a batch.
SLICE_BYTES = 4 << 20


# What Spark hands to Python at one time. By its default, 64 MB, a worker and its
# executor would hold several such batches.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> SparkSession:
    """The session with batches of bounded size, for tables with long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


@dataclass(frozen=True)
class Fields:
    """The columns an operator reads; all others are ignored or passed through."""

    key: str = "doc_id"
    text: str = "text"


def keyed_texts(docs: DataFrame, fields: Fields) -> DataFrame:
    """Only the key and the text, under fixed names, so that no other name can clash."""
    return docs.select(F.col(fields.key).alias("key"), F.col(fields.text).alias("text"))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about ``limit`` bytes of text in ``column``."""
    sizes = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64
    )
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def map_slices(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    column: str = "text",
) -> DataFrame:
    """``function`` on every slice of every batch, without a shuffle."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in slices(batch, column):
                yield function(part)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]
