"""The operators on the test tables, by query name."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import (
    bpe,
    conversations,
    decontaminate,
    htmltext,
    langid,
    lm,
    pieces,
    pii,
    resampling,
    simhash,
    tokenfiles,
    topk,
    toxicity,
)
from shopledger.llm.batches import small_batches
from shopledger.session import input_bytes_of, tune
from shopledger.sources.staging import stage, staging_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, folder: build(small_batches(tune(spark)), folder)
    return build


# Up to this size Spark's own number of reducers will do.
SMALL = 200 << 30


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; the session is sized for it if it is large."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    size = input_bytes_of([table]) or 0
    if size > SMALL:
        tune(spark, size)
    return table


def _in_fold(folds: int, fold: int) -> Column:
    """Whether the crc32 of doc_id's text leaves ``fold`` on division by ``folds``; NULL
    where doc_id is."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold


def _held_out(folds: int, fold: int) -> Column:
    """Rows of one fold; not those without a doc_id, whose fold is unknown."""
    return F.coalesce(_in_fold(folds, fold), F.lit(False))


def _learned(folds: int, fold: int) -> Column:
    """Rows of the other folds; not those without a doc_id either."""
    return F.coalesce(~_in_fold(folds, fold), F.lit(False))


@_query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the two folds that are not held out."""
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs.filter(_learned(3, 1)))
    return langid.predict(docs, model).withColumnRenamed("key", "doc_id").withColumn(
        "held_out", _held_out(3, 1)
    )


@_query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Where every document's ids are in the files, and their checksum, read back.

    The index says where the first document of each key is; the others, those with a null
    key and all checksums come from the shards.
    """
    docs, staged = _table(spark, folder, "documents"), staging_folder(spark)
    path, index = f"{staged}/shards", f"{staged}/index"
    tokenizer = tokenizer_file("word_bpe_49k.json").decode()
    tokenfiles.write_shards(docs, path, tokenizer, end_id=2)
    found = stage(tokenfiles.documents(spark, path), staged, "documents")
    tokenfiles.write_index(found, index)
    return (
        tokenfiles.placed(found, docs, spark.read.parquet(index))
        .join(tokenfiles.shard_starts(found), "shard")
        .select(
            F.col("key").alias("doc_id"),
            (F.col("before") + F.col("first")).alias("start"),
            F.col("n_ids").alias("n_tokens"),
            "ids_crc32",
        )
    )


@_query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learned from the four folds not held out."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.filter(_learned(5, 0)), staging_folder(spark))
    return (
        toxicity.score(docs, model)
        .withColumnRenamed("key", "doc_id")
        .withColumn("held_out", _held_out(5, 0))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


# The pseudonyms of the test tables need no secrecy; a real key comes from a vault.
PII_KEY = b"test tables"


@_query
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text with pseudonyms, and what was replaced."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, findings="findings").withColumn(
        "n_replaced", F.size("findings").cast("long")
    )


def tokenizer_file(name: str) -> bytes:
    """A public vocabulary file, read on the driver: its size is fixed."""
    return Path(public_tokenizers.path(name)).read_bytes()


@_query
def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, folder, "pages")
    found = htmltext.extract(pages, htmltext.fit(pages), carried=("url",))
    return found.select(
        F.col("key").alias("page_id"),
        "url",
        F.col("main_text").alias("text"),
        F.length("main_text").cast("long").alias("n_chars"),
    )


@_query
def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probabilities of every document, learned from the four folds not held out."""
    docs = _table(spark, folder, "documents")
    found = lm.score(docs, _learned(5, 1), staging_folder(spark))
    return found.withColumnRenamed("key", "doc_id").select(
        "doc_id", _held_out(5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


@_query
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document, and the text they decode to."""
    model = tokenizer_file("piece_bpe_32k.model")
    found = pieces.encode(_table(spark, folder, "documents"), model, decoded=True)
    return found.withColumnRenamed("key", "doc_id")


@_query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in which a benchmark item occurs, with the item and the place."""
    found = decontaminate.find(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )
    return found.withColumnsRenamed({"key": "doc_id", "item": "item_id"})


@_query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, folder, "documents"), staging_folder(spark))
    return found.select(
        F.col("key").alias("doc_id"),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@_query
def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest other vectors of every fiftieth vector."""
    vectors = _table(spark, folder, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, staging_folder(spark))


@_query
def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's weight towards the benchmark, and its rank if it is drawn."""
    found = resampling.resample(
        _table(spark, folder, "documents"),
        _table(spark, folder, "benchmark"),
        staging_folder(spark),
        features=resampling.Features(ngrams=1, buckets=10_000),
        percent=10,
        min_words=20,
        seed=2024,
    )
    return found.select(
        F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank"
    )


def _damaged(turns: DataFrame) -> DataFrame:
    """Turns of the test table with faults, of a kind that their place decides."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    place = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    kind, text = F.col("kind"), F.col("text")
    emptied = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
    return (
        turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"))
        .withColumn("kind", F.crc32(place.cast("binary")) % 20)
        .filter(kind != 0)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            emptied.otherwise(text).alias("text"),
            F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        )
        .drop("col")
    )


@_query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    table = _table(spark, folder, "conversations")
    found = conversations.repair(_damaged(table), staging_folder(spark))
    report = ["key", *conversations.REPORT_NAMES]
    lines = F.array_join(
        F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text)), "\n"
    )
    whole = found.whole.select(*report, "edits", F.sha2(lines, 256).alias("sha256"))
    digests = conversations.line_digests(found.long_pieces).withColumnRenamed("key", "digest_key")
    parted = found.long_report.join(digests, F.col("key").eqNullSafe(F.col("digest_key")))
    solved = whole.unionByName(parted.drop("digest_key"))
    ids = table.select("conv_id").distinct()
    zero = F.lit(0).cast("long")
    return ids.join(solved, F.col("conv_id").eqNullSafe(F.col("key")), "left").select(
        "conv_id",
        *[F.coalesce(name, zero).alias(name) for name in conversations.REPORT_NAMES],
        F.coalesce("edits", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@_query
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    model = tokenizer_file("byte_bpe_50k.json")
    found = bpe.encode(_table(spark, folder, "documents"), model, decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        F.col("key").alias("doc_id"),
        "n_tokens",
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
