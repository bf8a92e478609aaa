"""A corpus pipeline over ``documents``: five stages, each on all rows the last one kept.

Language ID drops what has no clear language, near-duplicates leave one document of
each group, decontamination drops documents with benchmark passages, personal data are
replaced by pseudonyms, and the texts that stay are encoded as pieces and decoded.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import decontaminate, langid, pieces, pii, simhash
from shopledger.llm.batches import small_batches
from shopledger.llm.queries import PII_KEY, tokenizer_file
from shopledger.session import tune
from shopledger.sources.staging import stage, staging_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(build: Stage) -> Stage:
    """A stage that sets the session up before it builds its plan."""

    @wraps(build)
    def prepared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return build(small_batches(tune(spark)), docs, sf_dir)

    return prepared


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted, by dictionaries from a sample of ``docs``."""
    return langid.keep_accepted(docs, langid.fit(docs))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return simhash.keep_one_of_each(docs, staging_folder(spark))


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.keep_clean(docs, benchmark, folder=staging_folder(spark))


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in the text; ``n_chars`` follows the new text."""
    found = pii.pseudonymise(docs, PII_KEY)
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


@_stage
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text they decode to."""
    found = pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), decoded=True)
    return found.withColumnRenamed("key", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", sentencepiece),
]

# Compression, hashing of shingles, random walks and merging are beyond SQL; the tests
# compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each writes Parquet that the next one reads."""
    folder = staging_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), folder, name)
    return docs
