"""Importance resampling towards a target distribution, counted by distinct lines.

Features are hashed runs of one to ``ngrams`` words. Newlines separate words, so they cut
a text into lines whose inner features do not depend on the rest. Equal lines of all
texts are merged first; a distinct line's features are found once and count as often as
the line occurs. Runs that span lines are found per text, from the words near line ends,
and added.

Per bucket of features the gain is a whole number, the log ratio of the smoothed shares
in the target and in all texts. A text's weight is the sum of its gains; its score adds
Gumbel noise made from its key, so that the best scores are a draw without replacement.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.batches import Fields, keyed_texts, slices
from shopledger.sources.staging import stage

# Letters and digits of ASCII and everything beyond ASCII make words; A-Z count as a-z.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


@dataclass(frozen=True)
class Features:
    """Runs of one to ``ngrams`` words, hashed into ``buckets``."""

    ngrams: int = 2
    buckets: int = 10_000

    def __post_init__(self):
        if self.ngrams < 1 or not 1 <= self.buckets <= 1 << 20:
            raise ValueError("ngrams must be positive and buckets from 1 to 1,048,576")

    def inside(self, words: list[bytes]) -> list[int]:
        """The hashes of the runs of a line's words."""
        found = list(map(crc32, words))
        for n in range(2, self.ngrams + 1):
            found += [crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
        return found

    def across(self, lines: Iterable[list[bytes]]) -> list[int]:
        """The hashes of the runs that span lines.

        Such a run has no word further than ``ngrams - 1`` from a line end, so of a long
        line only its ends are kept, with a gap between them.
        """
        near = self.ngrams - 1
        if not near:
            return []
        kept: list[tuple[bytes | None, int]] = []
        for at, words in enumerate(lines):
            if len(words) > 2 * near:
                words = [*words[:near], None, *words[-near:]]
            kept += [(word, at) for word in words]
        found = []
        for n in range(2, self.ngrams + 1):
            for i in range(len(kept) - n + 1):
                if kept[i][1] != kept[i + n - 1][1]:
                    run = [word for word, _ in kept[i : i + n]]
                    if None not in run:
                        found.append(crc32(b" ".join(run)))
        return found

    def packed(self, hashes: list[list[int]]) -> tuple[pa.Array, pa.Array]:
        """(number of hashes, their buckets as bytes) of each list."""
        sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
        flat = np.fromiter(chain.from_iterable(hashes), np.uint32, int(sizes.sum()))
        raw = (flat % self.buckets).astype("<u4").tobytes()
        ends = np.concatenate(([0], np.cumsum(sizes))) * 4
        spans = zip(ends.tolist(), ends[1:].tolist())
        return pa.array(sizes), pa.array([raw[a:b] for a, b in spans], pa.binary())


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLDED).split()


def _name(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


@dataclass(frozen=True)
class Counted:
    """Staged tables: distinct lines and texts, each with packed features."""

    lines: DataFrame
    texts: DataFrame
    features: Features


def count_features(
    docs: DataFrame, folder: str, name: str, features: Features, fields: Fields = Fields()
) -> Counted:
    """Stages features of ``docs`` in ``folder``.

    ``lines``: name, occurrences, n_words, n, packed of every distinct line with a word.
    ``texts``: row, key, line names, n, packed of the runs across lines, of every row.
    A line that most texts share is merged in each task before the shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = keyed_texts(docs, fields).withColumn("text", text)
    kind = keyed.schema["key"].dataType.simpleString()
    line = F.explode(F.split("text", "\n")).alias("line")
    merged = (
        keyed.select(line)
        .filter(F.length(F.trim("line")) > 0)
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .select(F.col("line").cast("binary").alias("line"), "occurrences")
    )

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "line"):
                found = part.column("line").to_pylist()
                words = [words_of(raw) for raw in found]
                n, packed = features.packed([features.inside(w) for w in words])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_name(raw) for raw in found], pa.binary()),
                        part.column("occurrences"),
                        pa.array([len(w) for w in words], pa.int64()),
                        n,
                        packed,
                    ],
                    ["name", "occurrences", "n_words", "n", "packed"],
                )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines = [raw.split(b"\n") for raw in part.column("text").to_pylist()]
                names = [[_name(x) for x in found if words_of(x)] for found in lines]
                spans = [features.across(map(words_of, found)) for found in lines]
                n, packed = features.packed(spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("key"),
                        pa.array(names, pa.list_(pa.binary())),
                        n,
                        packed,
                    ],
                    ["row", "key", "names", "n", "packed"],
                )

    lines = merged.mapInArrow(
        distinct, "name binary, occurrences bigint, n_words bigint, n bigint, packed binary"
    )
    numbered = keyed.select(
        F.monotonically_increasing_id().alias("row"),
        "key",
        F.col("text").cast("binary").alias("text"),
    )
    texts = numbered.mapInArrow(
        whole, f"row bigint, key {kind}, names array<binary>, n bigint, packed binary"
    )
    return Counted(
        stage(lines.filter("n > 0"), folder, f"{name}_lines"),
        stage(texts, folder, f"{name}_texts"),
        features,
    )


def bucket_counts(counted: Counted) -> np.ndarray:
    """How many features of all texts each bucket holds.

    A task sends one row a bucket at most, and ``buckets`` rows reach the driver.
    """
    buckets = counted.features.buckets

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            times, raw = batch.column("occurrences").to_numpy(), batch.column("packed").to_pylist()
            found = np.frombuffer(b"".join(raw), "<u4")
            each = np.repeat(times, [len(x) // 4 for x in raw])
            np.add.at(total, found, each)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    parts = [
        counted.lines.select("occurrences", "packed"),
        counted.texts.filter("n > 0").select(F.lit(1).cast("long").alias("occurrences"), "packed"),
    ]
    sums = [part.mapInArrow(summed, "bucket bigint, n bigint") for part in parts]
    total = np.zeros(buckets, np.int64)
    for bucket, n in reduce(DataFrame.unionAll, sums).groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The thousandfold log ratio of a bucket's smoothed shares, rounded down."""
    s, t = raw.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(df: DataFrame, gain: np.ndarray, kept: str) -> DataFrame:
    """The columns ``kept`` and the sum of the gains of ``packed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("packed").to_pylist()
            each = gain[np.frombuffer(b"".join(raw), "<u4")]
            ends = np.cumsum([0, *(len(x) // 4 for x in raw)])
            before = np.concatenate(([0], np.cumsum(each)))
            sums = before[ends[1:]] - before[ends[:-1]]
            columns = [c for c in batch.schema.names if c != "packed"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sums, pa.int64())],
                [*columns, "weight"],
            )

    names = [part.split()[0] for part in kept.split(", ")]
    return df.select(*names, "packed").mapInArrow(run, f"{kept}, weight bigint")


def weights(counted: Counted, gain: np.ndarray) -> DataFrame:
    """(row, key, n_words, n_features, weight) of every text.

    Lines meet their weights by name; a line that many texts share is a skewed key, which
    AQE splits. A row of zeros per text keeps texts without lines.
    """
    kind = counted.texts.schema["key"].dataType.simpleString()
    lines = _weighed(counted.lines, gain, "name binary, n_words bigint, n bigint")
    own = counted.texts.select("row", "key", F.explode("names").alias("name"))
    zero = F.lit(0).cast("long")
    inside = own.join(lines, "name").select("row", "key", "n_words", "n", "weight")
    if counted.features.ngrams > 1:
        across = _weighed(counted.texts, gain, f"row bigint, key {kind}, n bigint")
    else:
        across = counted.texts.select("row", "key", "n", zero.alias("weight"))
    across = across.select("row", "key", zero.alias("n_words"), "n", "weight")
    return (
        inside.unionAll(across)
        .groupBy("row", "key")
        .agg(
            F.sum("n_words").alias("n_words"),
            F.sum("n").alias("n_features"),
            F.sum("weight").alias("weight"),
        )
    )


def noise(key: Column, seed: int) -> Column:
    """The thousandfold Gumbel noise of a key, rounded down; a null key counts as empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((head + 0.5) / float(1 << 32))))


def drawn(scored: DataFrame, folder: str, percent: int, eligible: Column) -> DataFrame:
    """``scored`` with the rank of the best ``percent`` of its eligible rows by score.

    Equal scores go by key, null keys last, then by row. Rows are ranged by that order and
    numbered within their ranges; a range's rank starts after the rows of those before it.
    Of the ranges only their sizes reach the driver.
    """
    order = [
        F.col("eligible").desc(), F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("row")
    ]
    ranged = (
        scored.withColumn("eligible", eligible)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
        .withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    )
    placed = stage(ranged, folder, "ranged")
    sizes = (
        placed.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("eligible").alias("eligible"))
        .orderBy("part")
        .collect()
    )
    wanted = percent * sum(size["eligible"] for size in sizes) // 100
    before, starts = 0, []
    for size in sizes:
        starts.append((size["part"], before))
        before += size["n"]
    offsets = placed.sparkSession.createDataFrame(starts, "part bigint, before bigint")
    rank = F.col("before") + F.col("at") + 1
    return placed.join(offsets, "part").withColumn("rank", F.when(rank <= wanted, rank))


def resample(
    docs: DataFrame,
    target: DataFrame,
    folder: str,
    *,
    features: Features = Features(),
    percent: int = 10,
    min_words: int = 20,
    seed: int = 0,
    fields: Fields = Fields(),
    target_fields: Fields = Fields(key="item_id"),
) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every row of ``docs``.

    ``rank`` counts from 1 over the best ``percent`` of the rows of at least ``min_words``
    words, and is null in the others. Null and empty texts have no words and weight 0;
    repeated keys and rows count each. Equal scores go by key, null keys last. An empty
    target has flat shares; empty ``docs`` give no rows. Other columns are ignored.
    Intermediate tables go to ``folder``.
    """
    found = count_features(docs, folder, "raw", features, fields)
    wanted = count_features(target, folder, "target", features, target_fields)
    gain = gains(bucket_counts(found), bucket_counts(wanted))
    scored = weights(found, gain).withColumn(
        "score", F.col("weight") + noise(F.col("key"), seed)
    )
    ranked = drawn(scored, folder, percent, F.col("n_words") >= min_words)
    return ranked.select("key", "n_words", "n_features", "weight", "score", "rank")
