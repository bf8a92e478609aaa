"""Token ids in raw shard files, with a minimal perfect hash index of the documents.

A shard file holds, little-endian: 8 bytes ``IDSHARD1``; five 64-bit numbers (shard,
documents, ids, bytes per id, documents with a null key); the ids of all its documents
one after the other, each with the end id; their keys (64 bits each; null keys are the
first ones); the position after each document's last id (64 bits each); one line feed.
Shards are numbered in the order of their keys.

The index is a table of buckets. A key's hash names its bucket, the bucket's perfect
hash function its slot, and the slot holds a fingerprint, the shard, the first id and
the number of ids. A lookup takes the same few steps at any size; the fingerprint
turns away keys that are not there.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from unicodedata import is_normalized
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.batches import SLICE_BYTES, Fields, keyed_texts, slices, texts_of

MAGIC = b"IDSHARD1"
HEAD_BYTES = len(MAGIC) + 5 * 8

# A shard is closed when it has this many bytes of ids, so that one fits in a task.
SHARD_BYTES = 8 << 20

# Shards of one task come one after the other.
SHARDS_PER_TASK = 1 << 20

# Words whose ids a worker remembers; beyond it the memory starts anew.
MAX_WORDS = 2_000_000

# Words of letters that are tokenized as one text.
JOINED = 64

KEYS_PER_BUCKET = 1 << 17

_PLAIN_SPACE = re.compile(r"[^ \t\n\r]+")
_CONTROL = re.compile("[\x1c-\x1f]")


def _hashes(words: list[str]) -> np.ndarray:
    """Python's 64-bit hashes of words: one process compares them with its own only."""
    return np.fromiter(map(hash, words), np.int64, len(words))


_TAIL = ".,;:!?)\"]}*-_/"
_BEFORE_TAIL = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def _stable(word: str) -> bool:
    """Whether composing and lower-casing leave a word of letters one."""
    return word.isascii() or (is_normalized("NFC", word) and word.lower().isalpha())


class WordEncoder:
    """Encodes texts with a tokenizer that treats words between white space apart.

    Each distinct word is tokenized once. Punctuation that ends a word after an ASCII
    letter or digit is tokenized apart, so it is taken off first; ASCII words are looked
    up in lower case. Both are checked against the tokenizer when it is loaded.
    """

    def __init__(self, tokenizer: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.end_id = end_id
        size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        probe = ["One two,", "a1.\nB,", "it's x. Y", "  É. è,\t"]
        whole = [self._ids([text])[0] for text in probe]
        apart = [[i for word in text.split() for i in self._ids([word])[0]] for text in probe]
        if whole != apart:
            raise ValueError("the tokenizer does not treat words apart")
        ab_, ab, tail, one_, one, dot = self._ids(["ab" + _TAIL, "ab", _TAIL, "1.", "1", "."])
        self.peel = ab_ == ab + tail and one_ == one + dot
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # An added token is looked for before the case is lost, and may end like a tail.
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.I)
        self.lower = self._ids(["AbC"]) == self._ids(["abc"])
        # Parsing the whole file for one setting would take more memory than the model.
        found = re.search(r'"end_of_word_suffix":\s*("(?:[^"\\]|\\.)*")', tokenizer)
        suffix = json.loads(found[1]) if found else None
        self.ends = np.zeros(size if suffix else 0, bool)
        if suffix:
            for token, at in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.ends[at] = token.endswith(suffix)
        self._forget()

    def _ids(self, words: list[str]) -> list[list[int]]:
        """The ids of each; a few at a time, as the library's own result is large."""
        encode = self.tokenizer.encode_batch_fast
        return [
            e.ids
            for at in range(0, len(words), 512)
            for e in encode(words[at : at + 512], add_special_tokens=False)
        ]

    def _forget(self) -> None:
        # Sorted hashes of the known words, the place of each, and the ids by place. A
        # line feed is never a word; at place 0 it stands for the end of a document.
        self.hashes = np.array([hash("\n")], np.int64)
        self.place = np.zeros(1, np.int32)
        self.flat = np.array([self.end_id], self.dtype)
        self.first, self.length = np.zeros(1, np.int64), np.ones(1, np.int32)

    def _found(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash; -1 if it is not known."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.place[at], -1)

    def _append(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Adds words by their hashes, which are distinct and not known."""
        firsts = len(self.flat) + np.cumsum(lengths) - lengths
        places = np.arange(len(self.first), len(self.first) + len(hashes), dtype=np.int32)
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.place = np.insert(self.place, at, places[order])
        self.flat = np.concatenate([self.flat, ids])
        self.first = np.concatenate([self.first, firsts])
        self.length = np.concatenate([self.length, lengths.astype(np.int32)])

    def _gathered(self, used: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, one after the other."""
        sizes = self.length[used]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.first[used] - (ends - sizes), sizes)]

    def _learn(self, words: list[str]) -> None:
        """Adds distinct words that are not known, and their parts before them."""
        peel, lower, guard = self.peel, self.lower, self.special.search
        cores, tails = [], []
        for word in words:
            plain, tail = word, "\n"
            special = guard(word)
            if lower and word.isascii() and not special:
                plain = word.lower()
            if peel and plain[-1] in _TAIL and not special:
                core = plain.rstrip(_TAIL)
                if core and core[-1] in _BEFORE_TAIL:
                    plain, tail = core, plain[len(core) :]
            cores.append(plain)
            tails.append(tail)
        self._learn_parts(list(dict.fromkeys((*cores, *set(tails)))))
        own = _hashes(words)
        rest = np.nonzero(self._found(own) < 0)[0]  # those that are not a part themselves
        used = np.stack([self._found(_hashes(cores))[rest], self._found(_hashes(tails))[rest]], axis=1)
        alone = used[:, 1] == 0  # a word without a tail
        lengths = self.length[used[:, 0]] + np.where(alone, 0, self.length[used[:, 1]])
        parts = used.ravel()
        self._append(own[rest], self._gathered(parts[parts != 0]), lengths)

    def _learn_parts(self, words: list[str]) -> None:
        """Tokenizes those of the distinct words that are not known. Words of letters only
        are one pre-token, whose last id ends a word, so many can be tokenized as one text
        and told apart again."""
        unknown = np.nonzero(self._found(_hashes(words)) < 0)[0].tolist()
        simple, rest = [], []
        for at in unknown:
            word = words[at]
            plain = self.ends.size and word.isalpha() and _stable(word)
            (simple if plain else rest).append(word)
        texts = [" ".join(simple[i : i + JOINED]) for i in range(0, len(simple), JOINED)]
        if texts:
            ids = np.concatenate([np.array(found, self.dtype) for found in self._ids(texts)])
            last = np.nonzero(self.ends[ids])[0]
            if len(last) == len(simple):
                self._append(_hashes(simple), ids, np.diff(last, prepend=-1))
            else:
                rest += simple
        if rest:
            found = self._ids(rest)
            flat = np.fromiter((i for ids in found for i in ids), self.dtype)
            self._append(_hashes(rest), flat, np.fromiter(map(len, found), np.int64, len(found)))

    def _places(self, words: list[str]) -> np.ndarray:
        """The place of each word, after learning those that are not known."""
        distinct, where, inverse = np.unique(
            _hashes(words), return_index=True, return_inverse=True
        )
        used = self._found(distinct)
        missing = np.nonzero(used < 0)[0]
        if len(missing) and len(self.hashes) > 1 and len(self.hashes) + len(missing) > MAX_WORDS:
            self._forget()
            used = self._found(distinct)
            missing = np.nonzero(used < 0)[0]
        if len(missing):
            self._learn([words[at] for at in where[missing].tolist()])
            used = self._found(distinct)
        return used[inverse]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids with end ids, number of ids of each text)."""
        words: list[str] = []
        counts = []
        for text in texts:
            # Python also splits at these controls, which are no white space elsewhere.
            found = _PLAIN_SPACE.findall(text) if _CONTROL.search(text) else text.split()
            words += found
            words.append("\n")
            counts.append(len(found) + 1)
        used = self._places(words)
        ends = np.cumsum(self.length[used], dtype=np.int64)
        document_ends = ends[np.cumsum(counts) - 1]
        return self._gathered(used), np.diff(document_ends, prepend=0)


@lru_cache(maxsize=1)
def _encoder(tokenizer: str, end_id: int) -> WordEncoder:
    return WordEncoder(tokenizer, end_id)


def _shard(number: int, ids: list[np.ndarray], counts: list[np.ndarray], keys: list) -> bytes:
    payload, lengths = np.concatenate(ids), np.concatenate(counts)
    nulls = sum(key is None for key in keys)
    head = np.array([number, len(keys), len(payload), payload.itemsize, nulls], "<i8")
    return b"".join(
        (
            MAGIC,
            head.tobytes(),
            payload.tobytes(),
            np.array([key or 0 for key in keys], "<i8").tobytes(),
            np.cumsum(lengths).astype("<i8").tobytes(),
        )
    )


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    fields: Fields = Fields(),
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encodes every whole text and writes shard files in ascending order of the key.

    Null texts are empty documents. Rows with a null key come first, rows with one key
    in the order of their text's hash. The key must be of an integer type. Files are
    written through Spark's committer, so a lost executor leaves no half shard. Before
    the encoding, rows are ranged by key; long texts only move once.
    """
    source = keyed_texts(docs, fields)
    if not isinstance(source.schema["key"].dataType, T.IntegralType):
        raise ValueError("the key must be an integer")
    order = ["key", "hash", "row"]
    # The row lets equal rows, of which there may be many, go to several tasks.
    ranged = (
        source.withColumn("hash", F.xxhash64("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("key", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, end_id)
        number = TaskContext.get().partitionId() * SHARDS_PER_TASK
        ids, counts, keys, size = [], [], [], 0
        for batch in batches:
            for part in slices(batch, "text", min(SLICE_BYTES // 2, shard_bytes)):
                found, lengths = encoder.encode(texts_of(part))
                ids.append(found)
                counts.append(lengths)
                keys += part.column("key").to_pylist()
                size += found.nbytes
                if size >= shard_bytes:
                    blob = _shard(number, ids, counts, keys)
                    yield pa.RecordBatch.from_arrays([pa.array([blob])], ["shard"])
                    number, ids, counts, keys, size = number + 1, [], [], [], 0
        if keys:
            blob = _shard(number, ids, counts, keys)
            yield pa.RecordBatch.from_arrays([pa.array([blob])], ["shard"])

    # The text writer copies the bytes of a value as they are and adds the separator.
    (
        ranged.mapInArrow(run, "shard binary")
        .select(F.col("shard").cast("string").alias("value"))
        .write.option("lineSep", "\n")
        .option("maxRecordsPerFile", 1)
        .option("compression", "none")
        .text(path)
    )


@dataclass(frozen=True)
class Shard:
    """A shard file's content."""

    number: int
    ids: np.ndarray
    keys: np.ndarray
    nulls: int
    ends: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1]))


def parse_shard(content: bytes) -> Shard:
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a shard file")
    number, documents, n_ids, width, nulls = np.frombuffer(content, "<i8", 5, len(MAGIC)).tolist()
    at = HEAD_BYTES
    ids = np.frombuffer(content, f"<u{width}", n_ids, at)
    at += n_ids * width
    keys = np.frombuffer(content, "<i8", documents, at)
    ends = np.frombuffer(content, "<i8", documents, at + documents * 8)
    return Shard(number, ids, keys, nulls, ends)


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """The shard files; a table without rows leaves an empty file, which is no shard."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.filter("length > 0")


def _each_shard(files: DataFrame, function, schema: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                yield function(parse_shard(content.as_py()))

    return files.select("content").mapInArrow(run, schema)


def documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(key, shard, first, n_ids, ids_crc32[, ids]) of every document in the files.

    ``first`` counts ids within the shard; the checksum is that of the ids as unsigned
    32-bit little-endian numbers.
    """

    def run(shard: Shard) -> pa.RecordBatch:
        wide = shard.ids.astype("<u4")
        sums = [crc32(wide[i:j]) for i, j in zip(shard.starts.tolist(), shard.ends.tolist())]
        null = np.arange(len(shard.keys)) < shard.nulls
        arrays = [
            pa.array(shard.keys, mask=null),
            pa.array(np.full(len(shard.keys), shard.number)),
            pa.array(shard.starts),
            pa.array(shard.ends - shard.starts),
            pa.array(sums, pa.int64()),
        ]
        names = ["key", "shard", "first", "n_ids", "ids_crc32"]
        if with_ids:
            offsets = np.concatenate(([0], shard.ends)).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(wide.astype("<i8"))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    schema = "key bigint, shard bigint, first bigint, n_ids bigint, ids_crc32 bigint"
    return _each_shard(
        shard_files(spark, path), run, schema + (", ids array<bigint>" if with_ids else "")
    )


def shard_starts(found: DataFrame) -> DataFrame:
    """(shard, before): the ids in all shards before each; one row per shard.

    ``found`` are the rows of ``documents``. Shards are numbered task by task, so they are
    summed by task first, and only tasks are ordered in one place.
    """
    sizes = found.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    sizes = sizes.withColumn("task", F.floor(F.col("shard") / SHARDS_PER_TASK))
    to_here = (Window.unboundedPreceding, -1)
    by_task = Window.partitionBy(F.lit(0)).orderBy("task").rowsBetween(*to_here)
    tasks = (
        sizes.groupBy("task")
        .agg(F.sum("n").alias("n"))
        .select("task", F.coalesce(F.sum("n").over(by_task), F.lit(0)).alias("tasks_before"))
    )
    in_task = Window.partitionBy("task").orderBy("shard").rowsBetween(*to_here)
    before = F.coalesce(F.sum("n").over(in_task), F.lit(0))
    return (
        sizes.withColumn("before", before)
        .join(tasks, "task")
        .select("shard", (F.col("before") + F.col("tasks_before")).alias("before"))
    )


# --- the index -----------------------------------------------------------------------

# Multipliers of a 64-bit mixer (SplitMix64).
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15

BITS_PER_KEY = 2  # of a level; more make fewer levels


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of int64 keys; different seeds give independent functions."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * _STEP % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


BUCKET_SEED, FINGERPRINT_SEED, FIRST_LEVEL_SEED = 0, 1, 2


class PerfectHash:
    """A minimal perfect hash function: bit arrays that keys try in turn.

    A key takes a position of the first level where no other key falls on its bit, and
    its slot is the number of bits set before it. No key is stored.
    """

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes = list(sizes)
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
        self.rank = np.concatenate(([0], np.cumsum(self.bits)))

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """For distinct int64 keys."""
        sizes, levels, left = [], [], keys
        while len(left):
            size = max(64, BITS_PER_KEY * len(left))
            at = (_hash(left, FIRST_LEVEL_SEED + len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        return PerfectHash(sizes, np.packbits(bits, bitorder="little").tobytes())

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 if no level has it. Strangers may get any slot."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        base = 0
        for level, size in enumerate(self.sizes):
            at = base + (
                _hash(keys[open_], FIRST_LEVEL_SEED + level) % np.uint64(size)
            ).astype(np.int64)
            hit = self.bits[at]
            found[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
            base += size
        return found

    def packed(self) -> bytes:
        return np.packbits(self.bits, bitorder="little").tobytes()


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, FINGERPRINT_SEED) >> np.uint64(32)).astype("<u4")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_hash(keys, BUCKET_SEED) % np.uint64(buckets)).astype(np.int64)


INDEX_SCHEMA = (
    "bucket bigint, buckets bigint, sizes array<bigint>, bits binary, prints binary, "
    "shards binary, firsts binary, counts binary"
)


def write_index(found: DataFrame, index_path: str) -> None:
    """Builds the index of shard files from the rows of ``documents`` and writes it as a
    table. Stage those rows: they are read twice.

    A bucket has about KEYS_PER_BUCKET keys whatever the total, so none outgrows a
    task. A repeated key leads to its first document; null keys are not indexed.
    """
    keyed = found.filter("key is not null").select("key", "shard", "first", "n_ids")
    buckets = max(1, -(-keyed.count() // KEYS_PER_BUCKET))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array(bucket_of(np.asarray(batch.column("key"), np.int64), buckets))
            yield pa.RecordBatch.from_arrays([own, *batch.columns], ["bucket", *batch.schema.names])

    def build(table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_numpy() for name in table.column_names}
        keys = columns["key"]
        function = PerfectHash.build(keys)
        by_slot = np.argsort(function.slots(keys))
        row = {
            "bucket": [int(columns["bucket"][0])],
            "buckets": [buckets],
            "sizes": [function.sizes],
            "bits": [function.packed()],
            "prints": [fingerprint(columns["key"][by_slot]).tobytes()],
            "shards": [columns["shard"][by_slot].astype("<i8").tobytes()],
            "firsts": [columns["first"][by_slot].astype("<i8").tobytes()],
            "counts": [columns["n_ids"][by_slot].astype("<i8").tobytes()],
        }
        return pa.table(row)

    (
        keyed.mapInArrow(
            dealt, "bucket bigint, key bigint, shard bigint, first bigint, n_ids bigint"
        )
        # A hot key is one entry before its bucket is gathered.
        .groupBy("bucket", "key").agg(F.min(F.struct("shard", "first", "n_ids")).alias("at"))
        .select("bucket", "key", "at.*")
        .groupBy("bucket")
        .applyInArrow(build, INDEX_SCHEMA)
        .write.mode("overwrite")
        .parquet(index_path)
    )


def look_up(keys: DataFrame, index: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, shard, first, n_ids) of the keys that are in the index.

    Keys meet the bucket of their hash; a repeated key is answered each time, null keys
    and strangers not at all (but one in four billion strangers has the fingerprint of
    the slot it falls into).
    """
    row = index.select("buckets").first()
    buckets = row["buckets"] if row else 1
    wanted = keys.select(F.col(key).cast("long").alias("key")).filter("key is not null")

    def find(asked: pa.Table, bucket: pa.Table) -> pa.Table:
        names = ["key", "shard", "first", "n_ids"]
        if not asked.num_rows or not bucket.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in names})
        part = bucket.slice(0, 1).to_pylist()[0]
        values = asked.column("key").to_numpy()
        function = PerfectHash(part["sizes"], part["bits"])
        slots = function.slots(values)
        prints = np.frombuffer(part["prints"], "<u4")
        known = slots >= 0
        known[known] = prints[slots[known]] == fingerprint(values[known])
        slots, values = slots[known], values[known]
        columns = [np.frombuffer(part[n], "<i8")[slots] for n in ("shards", "firsts", "counts")]
        return pa.table([pa.array(values), *map(pa.array, columns)], names=names)

    def dealt(batches):
        for batch in batches:
            values = np.asarray(batch.column("key"), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_of(values, buckets)), batch.column("key")], ["bucket", "key"]
            )

    return (
        wanted.mapInArrow(dealt, "bucket bigint, key bigint")
        .groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInArrow(find, "key bigint, shard bigint, first bigint, n_ids bigint")
    )


def placed(found: DataFrame, keys: DataFrame, index: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, shard, first, n_ids, ids_crc32) of every row of ``documents``.

    Looked up are the different ones of ``keys``. The index gives place and length of the
    first document of each key; documents with a null key or a key that has come before are
    only in the shards.
    """
    names = ["key", "n_ids"]
    places = look_up(keys.select(key).distinct(), index, key)
    told = places.select("shard", "first", *(F.col(n).alias(f"told_{n}") for n in names))
    return found.join(told, ["shard", "first"], "left").select(
        F.coalesce("told_key", "key").alias("key"),
        "shard",
        "first",
        F.coalesce("told_n_ids", "n_ids").alias("n_ids"),
        "ids_crc32",
    )


def fetch(keys: DataFrame, path: str, index_path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids) of the documents with the given keys.

    Only the shards that hold a wanted document are parsed.
    """
    spark = keys.sparkSession
    places = look_up(keys, spark.read.parquet(index_path), key).distinct()
    ids = documents(spark, path, with_ids=True).select("shard", "first", "ids")
    return places.join(ids, ["shard", "first"]).select("key", "ids")
