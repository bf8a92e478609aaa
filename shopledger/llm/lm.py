"""N-gram language model as a weighted backoff automaton.

Training texts give counts of n-grams. A state is a context that was seen; it has an
arc for each word seen after it, and a failure arc, with a weight, to the next shorter
context. The probability of a word after context h mixes orders:

    P(w | h) = L(h) * c(h w) / c(h) + (1 - L(h)) * P(w | shorter h)
    P(w)     = (c(w) + 0.5) / (N + 0.5 * (V + 1))

so an arc carries P(w | h), the failure arc 1 - L(h), and all words of a context sum to
one. L depends on how often h was seen, in powers of two, and is fitted. A text is
scored in one pass from left to right that carries the state.

The counts of a corpus fit on no one machine. Texts are dealt into blocks. A block
asks for the counts of the n-grams in its own texts, and tells how often they occur in
its training texts: sorted hashes and counts, packed by slices of the hash range. A
slice adds up what all blocks tell and answers each. So a block gets the part of the
automaton its texts can reach, with counts of the whole corpus, and no table of
n-grams is ever in one place. Words have 64-bit hashes, longer n-grams 48-bit ones.

Words and pairs are asked for together, longer n-grams by order in rounds of their own:
another block has an n-gram only if it has both shorter ones in it, which the answers of
the round before tell. Of the rest a block knows the whole count itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.batches import Fields, slices
from shopledger.session import input_bytes_of

ORDER = 3

END, BEGIN = 0, 1
# White space is in no word, so these cannot be words of a text.
_END_WORD, _BEGIN_WORD = b"\n", b"\r"


@dataclass(frozen=True)
class Settings:
    """Sizes of blocks.

    A block holds about ``block_bytes`` of text; a longer text is a block of its own. A
    slice is what ``blocks_per_slice`` blocks ask for. A block sends a row to every slice,
    so their number grows with blocks * slices; for corpora of many terabytes raise both
    sizes with the memory of the executors. Of ``n`` distinct n-grams longer than a word a
    share of about n / 2 ** ``gram_bits`` meet another one's hash.
    """

    order: int = ORDER
    block_bytes: int = 2 << 20
    blocks_per_slice: int = 12
    gram_bits: int = 48

    def bits(self, n: int) -> int:
        """Bits of the hashes of n-grams of one order."""
        return 64 if n == 1 else self.gram_bits


# --- texts in blocks -------------------------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased in A-Z, split at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them all, one byte of each at a time.

    Bytes of one rank lie together, so what compresses the result finds the high ones,
    most of which are zero.
    """
    most = int(numbers.max(initial=0))
    width = max(1, -(-most.bit_length() // 8))
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + planes.T.tobytes()


def _unpacked_bits(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _unpacked(data: bytes) -> np.ndarray:
    return _unpacked_bits(data).view(np.int64)


def _packed_hashes(sorted_: np.ndarray) -> bytes:
    """Sorted hashes as a first one and differences, which are mostly short."""
    return _packed(np.diff(sorted_, prepend=np.uint64(0)).astype(np.uint64))


def _unpacked_hashes(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked_bits(data), dtype=np.uint64)


# Texts of one block bucket, by the size of the input files.
BUCKET_BYTES = 64 << 20


def _buckets(df: DataFrame) -> int:
    """How many buckets: as many as a shuffle has partitions, or more for a large input."""
    conf = df.sparkSession.conf
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(conf.get(name, None) or conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-(input_bytes_of([df]) or 0) // BUCKET_BYTES))


def _bucketed(df: DataFrame, path: str, table: str, buckets: int) -> DataFrame:
    """``df`` added to a table bucketed by its block, which later passes need not shuffle."""
    spark = df.sparkSession
    (
        df.write.mode("append")
        .option("path", path)
        .option("compression", "zstd")
        .bucketBy(buckets, "block")
        .saveAsTable(table, format="parquet")
    )
    return spark.table(table)


def _numbered(texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(words, sizes, numbers): the distinct words in order of their first use, how many
    words each text has, and all texts' words by number. The first two numbers are the end
    and the beginning."""
    numbers: dict[bytes, int] = {_END_WORD: END, _BEGIN_WORD: BEGIN}
    split = [words_of(text) for text in texts]
    for words in split:
        for word in words:
            if word not in numbers:
                numbers[word] = len(numbers)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    inner = np.fromiter(
        map(numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum())
    )
    # White space is in no word, so that it can part them.
    return b" ".join(list(numbers)[2:]), sizes, inner


def in_blocks(
    docs: DataFrame,
    train: Column,
    folder: str,
    table: str,
    fields: Fields = Fields(),
    settings: Settings = Settings(),
) -> DataFrame:
    """(block, keys, train, sizes, numbers, words), staged as ``table``: one row a block, with its texts
    as word numbers. Rows do not move: a block is made of rows that one task reads one
    after the other, and texts are cut into words once."""
    source = docs.select(
        F.col(fields.key).alias("key"),
        F.col(fields.text).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 24, 0
        parts: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks()
            words, sizes, numbers = _numbered(rows.column("text").to_pylist())
            whole = np.array([0, rows.num_rows], np.int32)
            lists = [
                pa.ListArray.from_arrays(whole, rows.column(name).combine_chunks())
                for name in ("key", "train")
            ]
            blobs = [pa.array([x], pa.binary()) for x in (_packed(sizes), _packed(numbers), words)]
            names = ["block", "keys", "train", "sizes", "numbers", "words"]
            return pa.RecordBatch.from_arrays([pa.array([block]), *lists, *blobs], names)

        for batch in batches:
            for part in slices(batch, "text", settings.block_bytes // 4):
                parts.append(part)
                size += part.column("text").nbytes
                if size >= settings.block_bytes:
                    yield packed()
                    parts, block, size = [], block + 1, 0
        if parts:
            yield packed()

    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("keys", T.ArrayType(source.schema["key"].dataType)),
            T.StructField("train", T.ArrayType(T.BooleanType())),
            *(T.StructField(name, T.BinaryType()) for name in ("sizes", "numbers", "words")),
        ]
    )
    made = source.mapInArrow(run, schema)
    return _bucketed(made, f"{folder}/lm_blocks", table, _buckets(docs))


# --- n-grams of a block ------------------------------------------------------------------

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their beginning and their last word."""
    x = left * _MIX + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, where each occurs, and for each value its place among them."""
    order = np.argsort(values)
    in_order = values[order]
    first = np.ones(len(values), bool)
    first[1:] = in_order[1:] != in_order[:-1]
    inverse = np.empty(len(values), np.int64)
    inverse[order] = np.cumsum(first) - 1
    return in_order[first], order[first], inverse


@dataclass
class Grams:
    """The distinct n-grams of one order in a block, sorted by hash."""

    hashes: np.ndarray
    counts: np.ndarray  # in training texts of the block
    prefix: np.ndarray  # place of the (n-1)-gram without the last word
    suffix: np.ndarray  # place of the (n-1)-gram without the first word
    last: np.ndarray  # local number of the last word
    at: np.ndarray  # n-gram that ends at each position; -1 if none


class BlockTexts:
    """The texts of a block as local word numbers, and their n-grams."""

    def __init__(self, rows: pa.Table, order: int, settings: Settings = Settings()):
        """Of a table (row, key, text, train)."""
        rows = rows.sort_by("row")
        texts = rows.column("text").to_pylist()
        train = np.asarray(rows.column("train"), bool)
        self._build(rows.column("key"), train, *_numbered(texts), order, settings)

    @classmethod
    def of(cls, block: pa.Table, order: int, settings: Settings) -> BlockTexts:
        """Of a row of ``in_blocks``."""
        texts = cls.__new__(cls)
        numbers = [_unpacked(block.column(name)[0].as_py()) for name in ("sizes", "numbers")]
        train = np.asarray(block.column("train")[0].values.to_numpy(zero_copy_only=False), bool)
        words = block.column("words")[0].as_py()
        texts._build(block.column("keys")[0].values, train, words, *numbers, order, settings)
        return texts

    def _build(
        self, keys, train: np.ndarray, words: bytes, inner_sizes: np.ndarray, inner: np.ndarray,
        order: int, settings: Settings,
    ) -> None:
        self.keys, self.train = keys, train
        numbers = [_END_WORD, _BEGIN_WORD, *words.split()]
        sizes = inner_sizes + 2
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.text = np.full(int(sizes.sum()), END, np.int64)
        place = np.ones(len(self.text), bool)
        place[self.starts] = place[self.ends - 1] = False
        self.text[self.starts] = BEGIN
        self.text[place] = inner
        self.n_words = len(numbers)
        in_train = np.repeat(train, sizes)
        depth = np.arange(len(self.text)) - np.repeat(self.starts, sizes)

        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(map(digest, numbers), np.uint64, len(numbers))
        order_ = np.argsort(hashes, kind="stable")
        rank = np.empty_like(order_)
        rank[order_] = np.arange(len(order_))
        at = rank[self.text]
        counts = np.bincount(at[in_train], minlength=len(order_))
        none = np.zeros(len(order_), np.int64)
        self.rank = rank
        self.grams = [Grams(hashes[order_], counts, none, none, order_, at)]
        for n in range(2, order + 1):
            below = self.grams[-1]
            whole = depth >= n - 1
            end = np.nonzero(whole)[0]
            hashed = _joined(below.hashes[below.at[end - 1]], hashes[self.text[end]])
            hashed >>= np.uint64(64 - settings.bits(n))
            distinct, sample, inverse = _distinct(hashed)
            sample = end[sample]
            at = np.full(len(self.text), -1, np.int64)
            at[end] = inverse
            counts = np.bincount(inverse[in_train[end]], minlength=len(distinct))
            self.grams.append(
                Grams(distinct, counts, below.at[sample - 1], below.at[sample], self.text[sample], at)
            )


def _slice_bounds(bits: int, slices_: int) -> np.ndarray:
    """Where each slice of the range of hashes begins."""
    return np.array([(i << bits) // slices_ for i in range(slices_)], np.uint64)


def _elsewhere(texts: BlockTexts, shared: list[np.ndarray], n: int) -> np.ndarray:
    """Which n-grams of order ``n`` can occur in other blocks.

    ``shared`` tells of the orders below which other blocks have. Words and pairs all can.
    """
    grams = texts.grams[n - 1]
    if n < 3:
        return np.ones(len(grams.hashes), bool)
    return shared[n - 2][grams.prefix] & shared[n - 2][grams.suffix]


# --- counts of the whole corpus --------------------------------------------------------


ASKED = "slice bigint, block bigint, n int, hashes binary, counts binary"


def _asked(
    blocks: DataFrame,
    answers: DataFrame | None,
    orders: tuple[int, ...],
    slices_: int,
    settings: Settings,
) -> DataFrame:
    """What the blocks ask and tell of these orders, after the answers to the ones below."""
    bounds = {n: _slice_bounds(settings.bits(n), slices_) for n in orders}

    def asked_by(block: pa.Table, found: pa.Table | None) -> pa.Table:
        texts = BlockTexts.of(block, max(orders), settings)
        known = _counts_of(texts, found, min(orders) - 1)[1] if found is not None else []
        out: dict[str, list] = {"slice": [], "n": [], "hashes": [], "counts": []}
        for n in orders:
            grams = texts.grams[n - 1]
            wanted = _elsewhere(texts, known, n)
            hashes, counts = grams.hashes[wanted], grams.counts[wanted]
            cuts = np.append(np.searchsorted(hashes, bounds[n], "left"), len(hashes))
            for i in np.nonzero(np.diff(cuts))[0].tolist():
                own = slice(cuts[i], cuts[i + 1])
                out["slice"].append(i)
                out["n"].append(n)
                out["hashes"].append(_packed_hashes(hashes[own] - bounds[n][i]))
                out["counts"].append(_packed(counts[own]))
        number = block.column("block")[0].as_py()
        return pa.table(
            {
                "slice": pa.array(out["slice"], pa.int64()),
                "block": pa.array([number] * len(out["n"]), pa.int64()),
                "n": pa.array(out["n"], pa.int32()),
                "hashes": pa.array(out["hashes"], pa.binary()),
                "counts": pa.array(out["counts"], pa.binary()),
            }
        )

    if answers is not None:
        return _with_answers(blocks, answers, asked_by, ASKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block = pa.Table.from_batches([batch.slice(at, 1)])
                yield from asked_by(block, None).to_batches()

    return blocks.mapInArrow(run, ASKED)


def _with_answers(blocks: DataFrame, answers: DataFrame, function, schema) -> DataFrame:
    """``function`` of every block and its answers, both of which lie in the block's bucket."""
    own = answers.filter("block >= 0").select("block", "n", "slice", "counts")

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        return function(block, found)

    return blocks.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(run, schema)


_BEGIN_HASH = np.uint64(xxhash.xxh64_intdigest(_BEGIN_WORD))


def _answered(asked: DataFrame, slices_: int, settings: Settings) -> DataFrame:
    """(block, n, slice, counts, kinds, tokens): what each block asked, over all blocks.

    ``kinds`` and ``tokens`` are the slice's share of V and N, on one row of the slice
    with block -1.
    """

    words_from = _slice_bounds(settings.bits(1), slices_)

    def run(rows: pa.Table) -> pa.Table:
        which = rows.column("slice")[0].as_py()
        order = np.asarray(rows.column("n"))
        answers: list[bytes | None] = [None] * rows.num_rows
        kinds = tokens = 0
        for n in np.unique(order).tolist():
            mine = np.nonzero(order == n)[0]
            hashes = [_unpacked_hashes(rows.column("hashes")[int(i)].as_py()) for i in mine]
            told = [_unpacked(rows.column("counts")[int(i)].as_py()) for i in mine]
            distinct, _, inverse = _distinct(np.concatenate(hashes))
            # Sums of whole numbers below 2**53 are exact.
            totals = np.bincount(inverse, np.concatenate(told), len(distinct)).astype(np.int64)
            # The lowest bit tells whether several blocks have the n-gram.
            answer = 2 * totals + (np.bincount(inverse, minlength=len(distinct)) > 1)
            at = 0
            for i, own in zip(mine, hashes):
                answers[int(i)] = _packed(answer[inverse[at : at + len(own)]])
                at += len(own)
            if n == 1:
                words = distinct + words_from[which] != _BEGIN_HASH
                kinds = int((totals[words] > 0).sum())
                tokens = int(totals[words].sum())
        size = rows.num_rows
        return pa.table(
            {
                "block": pa.array([*rows.column("block").to_pylist(), -1], pa.int64()),
                "n": pa.array([*order.tolist(), 0], pa.int32()),
                "slice": pa.array([which] * (size + 1), pa.int64()),
                "counts": pa.array([*answers, b""], pa.binary()),
                "kinds": pa.array([0] * size + [kinds], pa.int64()),
                "tokens": pa.array([0] * size + [tokens], pa.int64()),
            }
        )

    return asked.groupBy("slice").applyInArrow(
        run, "block bigint, n int, slice bigint, counts binary, kinds bigint, tokens bigint"
    )


# --- the automaton ---------------------------------------------------------------------

LEVELS = 40  # powers of two of a context's count


@dataclass(frozen=True)
class Mixture:
    """N, V and the weight of each order above the first by the context's count."""

    tokens: int
    kinds: int
    weights: tuple[tuple[float, ...], ...]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.kinds + 1))

    def weight(self, n: int, counts: np.ndarray) -> np.ndarray:
        """L of contexts of n-grams of order ``n`` that were seen ``counts`` times."""
        return np.array(self.weights[n - 2])[_level(counts)]


def _level(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(counts, 1)).astype(np.int64)


# Weights before fitting: higher for contexts seen more often.
FIRST_WEIGHTS = tuple(0.1 + 0.4 * level / LEVELS for level in range(LEVELS))


class Probabilities:
    """P of every n-gram of a block, by order; ``counts`` are those of the corpus."""

    def __init__(self, texts: BlockTexts, counts: list[np.ndarray], mixture: Mixture):
        self.counts = counts
        self.p = [mixture.unigram(counts[0])]
        self.weights: list[np.ndarray] = []
        for n in range(2, len(texts.grams) + 1):
            grams = texts.grams[n - 1]
            context = counts[n - 2]
            weight = np.where(context > 0, mixture.weight(n, context), 0.0)
            share = counts[n - 1] / np.maximum(context[grams.prefix], 1)
            own = weight[grams.prefix]
            self.p.append(own * share + (1 - own) * self.p[-1][grams.suffix])
            self.weights.append(weight)


class Automaton:
    """States, arcs and failure arcs that the texts of a block can reach.

    State 0 is the empty context, with an arc for every word; the others are the
    n-grams below the highest order that were seen and can go on.
    """

    def __init__(self, texts: BlockTexts, counts: list[np.ndarray], mixture: Mixture):
        found = Probabilities(texts, counts, mixture)
        grams, order = texts.grams, len(texts.grams)
        first, size = [], 1
        for n in range(1, order):
            first.append(size)
            size += len(grams[n - 1].hashes)
        # The state of each n-gram, or of the longest shorter one that is a state.
        state: list[np.ndarray] = []
        for n in range(1, order + 1):
            ends = grams[n - 1].last == END
            shorter = (
                np.zeros(len(ends), np.int64) if n == 1 else state[n - 2][grams[n - 1].suffix]
            )
            if n == order:
                state.append(shorter)
            else:
                own = first[n - 1] + np.arange(len(ends))
                state.append(np.where((counts[n - 1] > 0) & ~ends, own, shorter))
        fail_to, fail_weight = np.zeros(size, np.int64), np.zeros(size)
        keys, weights, targets = [], [], []
        for n in range(1, order + 1):
            own = grams[n - 1]
            seen = np.ones(len(own.last), bool) if n == 1 else counts[n - 1] > 0
            source = np.zeros(len(own.last), np.int64) if n == 1 else first[n - 2] + own.prefix
            keys.append((source * texts.n_words + own.last)[seen])
            weights.append(np.log10(found.p[n - 1][seen]))
            targets.append(state[n - 1][seen])
            if n < order:
                here = slice(first[n - 1], first[n - 1] + len(own.last))
                if n > 1:
                    fail_to[here] = state[n - 2][own.suffix]
                fail_weight[here] = np.log10(1 - found.weights[n - 1])
        # Arcs by state and word, in order, to be found by binary search.
        arcs = np.concatenate(keys)
        in_order = np.argsort(arcs)
        self.arcs = arcs[in_order]
        self.weights = np.concatenate(weights)[in_order]
        self.targets = np.concatenate(targets)[in_order]
        self.fail_to, self.fail_weight = fail_to, fail_weight
        self.n_words, self.memory = texts.n_words, order - 1
        self.begin = int(state[0][texts.rank[BEGIN]])

    def _step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probabilities of the words, next states) from the states.

        Where a state has no arc for its word, its failure arc is taken, again and again;
        the empty context has an arc for every word.
        """
        weight, states = np.zeros(len(states)), states.copy()
        at = np.searchsorted(self.arcs, states * self.n_words + words)
        while True:
            arcs = states * self.n_words + words
            at[at == len(self.arcs)] = 0
            lost = np.flatnonzero(self.arcs[at] != arcs)
            if not len(lost):
                return weight + self.weights[at], self.targets[at]
            weight[lost] += self.fail_weight[states[lost]]
            states[lost] = self.fail_to[states[lost]]
            at[lost] = np.searchsorted(self.arcs, states[lost] * self.n_words + words[lost])

    def score(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The log10 probabilities of the texts that lie in ``words`` from start to end.

        All are read side by side, a word at a time, each carrying its state. Long texts are
        cut into stretches: a state depends on no more than the last ``memory`` words, so a
        stretch begins so many words early, in the empty context, and counts from its own
        first word on.
        """
        counts = -(-(ends - starts) // STRETCH)
        text = np.repeat(np.arange(len(starts)), counts)
        part = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = starts[text] + part * STRETCH
        last = np.minimum(first + STRETCH, ends[text])
        order = np.argsort(first - last, kind="stable")
        text, part, first, last = text[order], part[order], first[order], last[order]
        before = first - starts[text]
        # With fewer words before it, a stretch goes back to the text's beginning.
        states = np.where(before < self.memory, self.begin, 0)
        for back in range(self.memory, 0, -1):
            begun = np.flatnonzero(before >= back)
            _, states[begun] = self._step(states[begun], words[first[begun] - back])
        total = np.zeros(len(text))
        lengths = last - first
        for at in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -at, "left"))
            weight, states[:active] = self._step(states[:active], words[first[:active] + at])
            total[:active] += weight
        return np.bincount(text, total, len(starts))


# Words of a stretch of a text that is read beside others.
STRETCH = 256


# --- mixing weights ----------------------------------------------------------------------

RATIOS = 81  # bins of log10 of a share over the shorter context's probability


def _ratio_counts(texts: BlockTexts, counts: list[np.ndarray], mixture: Mixture):
    """(n, level, bin, times): training words, each left out of its own counts.

    Bin 0 is for words not seen otherwise after the context.
    """
    in_train = np.repeat(texts.train, texts.ends - texts.starts)
    found = Probabilities(texts, counts, mixture)
    out = []
    for n in range(2, len(texts.grams) + 1):
        grams = texts.grams[n - 1]
        at = grams.at[(grams.at >= 0) & in_train]
        context = counts[n - 2][grams.prefix[at]] - 1
        times = counts[n - 1][at] - 1
        at, times, context = at[context > 0], times[context > 0], context[context > 0]
        lower = found.p[n - 2][grams.suffix[at]]
        with np.errstate(divide="ignore"):
            ratio = np.log10(times / context / lower)
        bins = np.clip(np.nan_to_num(ratio * 5, neginf=-99) + 41, 1, RATIOS - 1).astype(np.int64)
        bins[times == 0] = 0
        code = _level(context) * RATIOS + bins
        total = np.bincount(code, minlength=LEVELS * RATIOS)
        used = np.nonzero(total)[0]
        out.append((np.full(len(used), n), used // RATIOS, used % RATIOS, total[used]))
    return [np.concatenate(x) for x in zip(*out)]


def fit_weight(times: np.ndarray, rounds: int = 100) -> float:
    """The weight that makes words with these ratio counts likeliest, by EM."""
    ratio = 10.0 ** ((np.arange(RATIOS) - 40.5) / 5)
    ratio[0] = 0
    weight = 0.5
    for _ in range(rounds):
        part = weight * ratio / (weight * ratio + 1 - weight)
        weight = min(max(float((times * part).sum() / times.sum()), 1e-4), 1 - 1e-4)
    return weight


def _counts_of(
    texts: BlockTexts, answers: pa.Table, most: int
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The corpus counts of a block's n-grams up to order ``most``, and which are shared.

    They are put together from the slices' answers; what no other block can have is
    counted in the block itself.
    """
    answers = answers.sort_by([("n", "ascending"), ("slice", "ascending")])
    order = np.asarray(answers.column("n"))
    out: list[np.ndarray] = []
    shared: list[np.ndarray] = []
    for n, grams in enumerate(texts.grams[:most], 1):
        parts = [_unpacked(answers.column("counts")[int(i)].as_py()) for i in np.nonzero(order == n)[0]]
        found = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        asked = _elsewhere(texts, shared, n)
        if len(found) != asked.sum():
            raise ValueError("a block's texts changed between two passes")
        counts = grams.counts.astype(np.int64)
        counts[asked] = found >> 1
        out.append(counts)
        shared.append(np.zeros(len(counts), bool))
        shared[-1][asked] = found & 1
    return out, shared


def score(
    docs: DataFrame,
    train: Column,
    folder: str,
    fields: Fields = Fields(),
    settings: Settings = Settings(),
    weights: tuple[tuple[float, ...], ...] | None = None,
) -> DataFrame:
    """(key, train, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model learns from the rows where ``train`` is true. ``weights`` are those of a
    Mixture, and are fitted if not given. Null texts are empty: they
    have the end as their only token. Repeated rows stay and count as often as they
    occur; other columns are ignored. Without training texts all tokens are unknown.
    """
    spark, buckets = docs.sparkSession, _buckets(docs)
    tables = [f"lm_{name}_{uuid4().hex}" for name in ("blocks", "answers")]
    blocks = in_blocks(docs, train, folder, tables[0], fields, settings)
    n_blocks = blocks.select("block").count()
    slices_ = max(1, -(-n_blocks // settings.blocks_per_slice))
    answers, rounds = None, [tuple(range(1, min(settings.order, 2) + 1))]
    rounds += [(n,) for n in range(3, settings.order + 1)]
    for orders in rounds:
        asked = _asked(blocks, answers, orders, slices_, settings)
        dealt = _answered(asked, slices_, settings).repartition(buckets, "block")
        answers = _bucketed(dealt, f"{folder}/lm_answers", tables[1], buckets)
    size = answers.filter("block = -1").agg(F.sum("kinds"), F.sum("tokens")).first()
    first = Mixture(size[1] or 0, size[0] or 0, (FIRST_WEIGHTS,) * (settings.order - 1))
    if weights is None:
        weights = _fitted(blocks, answers, first, settings)
    mixture = Mixture(first.tokens, first.kinds, weights)

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        texts = BlockTexts.of(block, settings.order, settings)
        counts, _ = _counts_of(texts, found, settings.order)
        automaton = Automaton(texts, counts, mixture)
        starts, ends = texts.starts + 1, texts.ends
        at = texts.grams[0].at
        known = np.concatenate(([0], np.cumsum((counts[0] > 0)[at])))
        unigram = np.log10(mixture.unigram(counts[0]))[at]
        text = np.repeat(np.arange(len(starts)), texts.ends - texts.starts)
        unigram[texts.starts] = 0  # the beginning is no token
        return pa.table(
            {
                "key": texts.keys,
                "train": pa.array(texts.train),
                "n_tokens": pa.array(ends - starts),
                "n_known": pa.array(known[ends] - known[starts]),
                "train_tokens": pa.array(np.full(len(starts), mixture.tokens)),
                "base_score": pa.array(np.bincount(text, unigram, len(starts))),
                "score": pa.array(automaton.score(texts.text, starts, ends)),
            }
        )

    schema = T.StructType(
        [T.StructField("key", blocks.schema["keys"].dataType.elementType)]
        + [T.StructField("train", T.BooleanType())]
        + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    )
    scored = _with_answers(blocks, answers, run, schema)
    # The plan knows the tables' files; their names need not stay in a shared catalog.
    for name in tables:
        spark.sql(f"DROP TABLE {name}")
    return scored


def _fitted(
    blocks: DataFrame, answers: DataFrame, first: Mixture, settings: Settings
) -> tuple[tuple[float, ...], ...]:
    """Mixing weights from all training texts."""
    if settings.order == 1:
        return first.weights
    names = ["n", "level", "bin", "times"]

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        if not any(block.column("train")[0].as_py()):
            return pa.table([pa.array([], pa.int64())] * len(names), names=names)
        texts = BlockTexts.of(block, settings.order, settings)
        counts, _ = _counts_of(texts, found, settings.order)
        columns = _ratio_counts(texts, counts, first)
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    told = (
        _with_answers(blocks, answers, run, "n bigint, level bigint, bin bigint, times bigint")
        .groupBy("n", "level", "bin").agg(F.sum("times").alias("times"))
    )
    rows = told.collect()  # at most orders * LEVELS * RATIOS
    if not rows:
        return first.weights
    table = np.zeros((settings.order + 1, LEVELS, RATIOS))
    for row in rows:
        table[row["n"], row["level"], row["bin"]] = row["times"]
    out = []
    for n in range(2, settings.order + 1):
        weights, last = [], FIRST_WEIGHTS[0]
        for level in range(LEVELS):
            # A level too rare to tell has the weight of the one below.
            last = fit_weight(table[n, level]) if table[n, level].sum() >= 100 else last
            weights.append(last)
        out.append(tuple(weights))
    return tuple(out)
