"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint is cut into segments A, B, C of 22, 21 and 21 bits. Two fingerprints
with at most two differing bits have one equal segment whose follower (A-B, B-C,
C-A) differs in at most one bit: with errors in two segments the third is equal and
its follower has one error; with both errors in one segment, the segment after it
is equal and so is the follower, or the follower's predecessor is. So a fingerprint
gets, for each segment, keys made of the segment's value and the Golay codewords
near the follower: at most 18 keys of about 33 bits. Fingerprints that meet in a
key are compared in full, so no link is lost and none is wrong.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.batches import Fields, keyed_texts, map_slices, texts_of
from shopledger.llm.components import components
from shopledger.llm.golay import codeword_keys
from shopledger.sources.staging import stage

# Hash seed and shingle length of the fingerprint.
SEED = 42
SHINGLE_WORDS = 3

MAX_BITS = 2

# (shift, bits) of the segments, and the follower whose codewords complete the key.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def _hashes(text: str) -> np.ndarray:
    """XXH64 of every shingle, repeats included; an empty array if there is no word."""
    # Bytes are lower-cased in A-Z only and split at ASCII white space only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE_WORDS:
        return np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -SHINGLE_WORDS])).tolist()
    stops = (ends[SHINGLE_WORDS - 1 :] - 1).tolist()
    found = [digest(joined[i:j], SEED) for i, j in zip(starts, stops)]
    return np.array(found, dtype=np.uint64)


# Shingles whose bits are counted at one time: bounds memory for very long texts.
_STEP = 1 << 16


def fingerprint(text: str) -> int:
    """The 64 majority bits of a text's shingle hashes; 0 without a word."""
    hashes = _hashes(text)
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    raw = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for start in range(0, len(raw), _STEP):
        counts += np.unpackbits(raw[start : start + _STEP], axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, fields: Fields = Fields()) -> DataFrame:
    """(key, fingerprint) of every row; the fingerprint is a signed long.

    Null and empty texts have fingerprint 0. Repeated rows stay.
    """
    source = keyed_texts(docs, fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t) for t in texts_of(batch)], dtype=np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(prints.view(np.int64))], ["key", "fingerprint"]
        )

    kind = source.schema["key"].dataType.simpleString()
    return map_slices(source, run, f"key {kind}, fingerprint bigint")


def fuzzy_keys(prints: np.ndarray) -> np.ndarray:
    """The keys of each fingerprint (signed longs), as a (n, 18) array with repeats."""
    bits = prints.view(np.uint64)
    parts = [((bits >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    keys = []
    for i, part in enumerate(parts):
        near = codeword_keys(parts[(i + 1) % len(parts)])
        keys.append((np.int64(i) << 40) | (part[:, None] << 12) | near)
    return np.concatenate(keys, axis=1)


def _keyed(prints: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = np.asarray(batch.column("fingerprint"), dtype=np.int64)
            keys = np.sort(fuzzy_keys(found), axis=1)
            own = np.concatenate((np.ones((len(keys), 1), bool), keys[:, 1:] != keys[:, :-1]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(found, own.sum(axis=1))), pa.array(keys[own])],
                ["fingerprint", "bucket"],
            )

    return prints.mapInArrow(run, "fingerprint bigint, bucket bigint")


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b, for all distinct fingerprints at most ``max_bits`` (0 to 2) apart.

    ``prints`` has distinct fingerprints. A fingerprint has at most 2,080 others
    within two bits, so the links grow with the fingerprints and not their square.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys find links of at most two bits")
    keyed = _keyed(prints)
    a, b = F.col("a"), F.col("b")
    left = keyed.select("bucket", F.col("fingerprint").alias("a"))
    right = keyed.select("bucket", F.col("fingerprint").alias("b"))
    near = F.bit_count(a.bitwiseXOR(b)) <= max_bits
    return left.join(right, "bucket").filter((a < b) & near).select("a", "b").distinct()


def _classes(
    docs: DataFrame, folder: str, fields: Fields, max_bits: int
) -> tuple[DataFrame, DataFrame]:
    """Staged (key, fingerprint) of every row, and (fingerprint, least key, root)."""
    prints = stage(fingerprints(docs, fields), folder, "fingerprints")
    distinct = stage(
        prints.groupBy("fingerprint").agg(F.min("key").alias("least")), folder, "distinct"
    )
    found = components(links(distinct.select("fingerprint"), max_bits), folder)
    rooted = distinct.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    root = F.coalesce("root", "fingerprint")
    classes = stage(
        rooted.select("fingerprint", "least", root.alias("root")), folder, "classes"
    )
    return prints, classes


def near_duplicates(
    docs: DataFrame, folder: str, fields: Fields = Fields(), max_bits: int = MAX_BITS
) -> DataFrame:
    """(key, fingerprint, component) of every row.

    ``component`` is the smallest key reachable over links between fingerprints; null
    keys only count where a component has no other. Equal fingerprints are merged
    before they are linked, so copies cost no links. ``folder`` is a staging folder.
    An empty table gives an empty result.
    """
    prints, classes = _classes(docs, folder, fields, max_bits)
    least = stage(
        classes.groupBy("root").agg(F.min("least").alias("component")), folder, "least_of_class"
    )
    members = classes.join(least, "root").select("fingerprint", "component")
    return prints.join(members, "fingerprint").select("key", "fingerprint", "component")


def keep_one_of_each(
    docs: DataFrame, folder: str, fields: Fields = Fields(), max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, without near-duplicates.

    Of each component the row with the smallest key stays; a null key stays only where
    there is no other. Of rows that share key and fingerprint one stays. Rows with an
    unrepeated key are chosen by the key alone; only the others are hashed again.
    """
    prints, classes = _classes(docs, folder, fields, max_bits)
    # The smallest key of a fingerprint is its candidate, the smallest of a root wins.
    by = F.struct(F.col("least").isNull(), "least", "fingerprint")
    winners = stage(
        classes.groupBy("root").agg(F.min(by).alias("w")).select(
            F.col("w.least").alias("key"), F.col("w.fingerprint").alias("fingerprint")
        ),
        folder,
        "winners",
    )
    counts = prints.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(
        counts.filter((F.col("n") > 1) & F.col("key").isNotNull()).select("key"), folder, "repeated"
    )
    key = docs[fields.key]
    chosen = winners.join(repeated, "key", "left_anti").filter("key is not null")
    plain = docs.join(chosen, key == chosen["key"], "left_semi")

    unclear = docs.join(repeated, key == repeated["key"], "left_semi").unionAll(
        docs.filter(key.isNull())
    )
    row, print_ = "row", "fingerprint"
    hashed = unclear.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
        F.col(fields.key).alias("key"),
        F.col(fields.text).alias("text"),
    )

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t) for t in texts_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(row), batch.column("key"), pa.array(found)], [row, "key", print_]
            )

    schema = T.StructType(
        [hashed.schema[row], hashed.schema["key"], T.StructField(print_, T.LongType())]
    )
    w = winners.select(F.col("key").alias("w_key"), F.col("fingerprint").alias("w_print"))
    again = (
        hashed.mapInArrow(run, schema)
        .join(w, F.col("key").eqNullSafe(w["w_key"]) & (F.col(print_) == w["w_print"]), "left_semi")
        .dropDuplicates(["key", print_])
        .select("row.*")
    )
    return plain.unionAll(again)
