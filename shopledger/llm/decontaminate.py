"""Benchmark passages in documents, also edited ones.

An item is found if some run of a document's words has a word edit distance of at most
``max_edits`` of the item's length. The CGK embedding reads a string with a pointer
that stays or moves by a random bit of the step and the symbol under it: strings at a
small edit distance soon read the same symbols again and stay close in Hamming
distance. Sampling a few steps of the walk gives a hash; windows at all positions of a
document and the items meet in equal hashes, over as many walks as the target recall
needs at each length of items. What meets is verified by exact edit distance.

An edit destroys at most q of an item's runs of q words. So a window that matches holds
at least (words - q + 1 - q * edits) runs of items; that is counted first, spares most
windows the walks and loses no match. Long items would need too many walks; windows with
enough runs of one of them are verified without.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.batches import Fields, keyed_texts, slices, texts_of
from shopledger.sources.staging import stage, staging_folder

# Scripts without spaces between words: Thai, Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff"
)
_WORD = re.compile(rf"(?=\w)[{_UNSPACED}]|[^\W{_UNSPACED}]+")


def words_of(text: str) -> list[str]:
    """Runs of letters and digits; in scripts without spaces, each letter."""
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Settings:
    """``recall`` is reached for items at the largest distance, on average over edits.

    Each class of lengths reaches it with at most ``max_walks`` walks, or is searched
    without walks, which finds all.
    Items of fewer than ``min_words`` words are found as exact runs of words only; items
    without a word are left out. Items are sent to tasks in blocks of about
    ``block_bytes`` of text.
    """

    max_edits: float = 0.2
    min_words: int = 5
    samples: int = 4
    recall: float = 0.99
    max_walks: int = 400
    block_bytes: int = 8 << 20
    seed: int = 20


# Item lengths of a class differ by this factor at most.
CLASS_STEP = 1.25

# A walk is sampled up to this many steps per word; its pointer moves at half speed.
STEPS_PER_WORD = 1.6

_STEP_BITS = 64


def max_distance(words: int, settings: Settings) -> int:
    return int(settings.max_edits * words + 1e-9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def edit_match(item: list[int], text: list[int], limit: int) -> tuple[int, int] | None:
    """(distance, end) of the run of ``text`` nearest to ``item``, if within ``limit``.

    Bit-parallel: a column of the alignment is two whole numbers. Of equal distances
    the first end wins.
    """
    m = len(item)
    masks: dict[int, int] = defaultdict(int)
    for at, word in enumerate(item):
        masks[word] |= 1 << at
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance = full, 0, m
    best, end = m, 0
    for at, word in enumerate(text):
        equal = masks.get(word, 0)
        cross = (((equal & plus) + plus) ^ plus) | equal | minus
        up = minus | (~(cross | plus) & full)
        down = plus & cross
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        # The row above the item is 0 everywhere: a match may begin at any word.
        diagonal = equal | minus
        plus = (down | (~(diagonal | up) & full)) & full
        minus = up & diagonal
        if distance < best:
            best, end = distance, at + 1
    return (best, end) if best <= limit else None


class Walks:
    """Items of one block, their hashes, and the search of documents."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings, walks: int | None = None):
        self.settings = settings
        split = [(key, words_of(text)) for key, text in items]
        # Items too short for edits, by their words.
        self.short: dict[tuple[str, ...], list[int]] = defaultdict(list)
        self.short_keys = [key for key, words in split if 0 < len(words) < settings.min_words]
        short = [tuple(words) for _, words in split if 0 < len(words) < settings.min_words]
        for at, run in enumerate(short):
            self.short[run].append(at)
        self.short_lengths = sorted({len(words) for words in self.short})
        self.short_firsts = {words[0] for words in self.short}
        split = [(key, words) for key, words in split if len(words) >= settings.min_words]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in split for w in ws}))}
        self.strange = len(self.vocabulary)  # the symbol of all other words and of padding
        self.keys = [key for key, _ in split] + self.short_keys
        self.items = [[self.vocabulary[w] for w in words] for _, words in split]
        self.limits = [max_distance(len(words), settings) for words in self.items]
        # Class of each item, and the shortest item of each class.
        classes = [int(np.log(len(words)) / np.log(CLASS_STEP)) for words in self.items]
        self.classes = sorted(set(classes))
        self.class_of = [self.classes.index(c) for c in classes]
        self.shortest = [
            min(len(w) for w, c in zip(self.items, classes) if c == own) for own in self.classes
        ]
        self.filters = [
            self._filter([(len(w), k) for w, k, c in zip(self.items, self.limits, classes) if c == own])
            for own in self.classes
        ]
        self.runs = {q: self._runs(q) for q in {q for q, _, _ in self.filters}}
        self.pad = max(map(len, self.items), default=0) * 2 + 2
        random = np.random.default_rng(settings.seed)
        self.most_walks = walks or settings.max_walks
        self.seeds = random.integers(0, 1 << 63, self.most_walks, dtype=np.int64).view(np.uint64)
        steps = [max(1, int(n * STEPS_PER_WORD)) for n in self.shortest]
        self.sampled = [
            [
                np.sort(random.choice(n, min(n, settings.samples), replace=False))
                for n in steps
            ]
            for _ in range(self.most_walks)
        ]
        # Walks of each class; None where the items' runs alone tell what to verify.
        self.walks_of = [
            walks or self._walks_for_recall(c) for c in range(len(self.classes))
        ]
        self.walks = max((n for n in self.walks_of if n), default=0)
        self.tables = [self._item_hashes(walk, self._walking(walk)) for walk in range(self.walks)]
        self.posted = {
            c: self._posted(c) for c, n in enumerate(self.walks_of) if n is None
        }

    @staticmethod
    def _filter(lengths: list[tuple[int, int]]) -> tuple[int, int, int]:
        """(q, runs needed, words of a window) for items with these lengths and limits."""
        span = max(n + k for n, k in lengths)
        for q in (3, 2, 1):
            needed = min(n - q + 1 - q * k for n, k in lengths)
            if needed > 1 or q == 1:
                return q, needed, span
        raise AssertionError

    def _coded(self, text: np.ndarray, q: int) -> np.ndarray:
        """The number of the run of ``q`` symbols at each place; -1 if one is strange."""
        base, length = np.uint64(self.strange + 1), max(0, len(text) - q + 1)
        code, known = np.zeros(length, np.uint64), np.ones(length, bool)
        for i in range(q):
            own = text[i : i + length]
            # Wraps around beyond two million words; then runs may share a number, which
            # only lets more windows through.
            code = code * base + own.astype(np.uint64)
            known &= own != self.strange
        return np.where(known, (code >> np.uint64(1)).astype(np.int64), -1)

    def _runs(self, q: int) -> np.ndarray:
        """The sorted numbers of all items' runs."""
        found = [self._coded(np.array(words, np.int64), q) for words in self.items]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def _windows(self, text: np.ndarray) -> list[np.ndarray]:
        """For each class, whether a window from each place may match."""
        counted = {}
        for q, runs in self.runs.items():
            codes = self._coded(text, q)
            here = np.nonzero(codes >= 0)[0]
            hit = np.zeros(len(text), bool)
            if len(runs):
                place = np.minimum(np.searchsorted(runs, codes[here]), len(runs) - 1)
                hit[here] = runs[place] == codes[here]
            counted[q] = np.concatenate(([0], np.cumsum(hit)))
        masks = []
        for q, needed, span in self.filters:
            known = counted[q]
            ends = np.minimum(np.arange(len(text)) + max(1, span - q + 1), len(text))
            masks.append(known[ends] - known[:-1] >= needed)
        return masks

    def _bits(self, walk: int, symbols: np.ndarray, step: int) -> np.ndarray:
        """The walk's random bit for each symbol at a step."""
        mixed = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.seeds[walk]
        return _mix(mixed + np.uint64(step * 0xD1B54A32D192ED03 % (1 << 64))) & np.uint64(1)

    def _hashes(
        self, walk: int, text: np.ndarray, starts: np.ndarray, classes: list[int]
    ) -> list[np.ndarray]:
        """For each class, the hash of the walk from every start."""
        wanted: dict[int, list[int]] = defaultdict(list)
        for c in classes:
            for step in self.sampled[walk][c]:
                wanted[int(step)].append(c)
        hashes = {c: np.full(len(starts), c + 1, np.uint64) for c in classes}
        at = starts.copy()
        last = max(wanted, default=-1)
        alphabet = np.arange(self.strange + 1)
        for step in range(last + 1):
            symbols = text[at]
            for c in wanted.get(step, ()):
                hashes[c] = _mix(hashes[c] * np.uint64(0x2545F4914F6CDD1D) + symbols.astype(np.uint64))
            if len(starts) > len(alphabet):
                at = at + self._bits(walk, alphabet, step).astype(np.int64)[symbols]
            else:
                at = at + self._bits(walk, symbols, step).astype(np.int64)
        return [hashes[c] for c in classes]

    def _laid(self, texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """The texts one after the other with padding between, and where each starts."""
        parts, starts, at = [], [], 0
        padding = np.full(self.pad, self.strange, np.int64)
        for words in texts:
            starts.append(at)
            parts += [np.asarray(words, np.int64), padding]
            at += len(words) + self.pad
        return np.concatenate(parts) if parts else padding, np.array(starts, np.int64)

    def _walking(self, walk: int) -> list[int]:
        """The classes that take a walk."""
        return [c for c, n in enumerate(self.walks_of) if n is not None and walk < n]

    def _item_hashes(self, walk: int, classes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(sorted hashes, item) over these classes."""
        members = np.nonzero(np.isin(self.class_of, classes))[0]
        text, starts = self._laid([self.items[i] for i in members])
        own = np.array(self.class_of)[members]
        every = np.zeros(len(members), np.uint64)
        for c, found in zip(classes, self._hashes(walk, text, starts, classes)):
            every[own == c] = found[own == c]
        order = np.argsort(every, kind="stable")
        return every[order], members[order]

    def _posted(self, c: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(runs, first place, items): the items of a class that hold each run, in order."""
        q = self.filters[c][0]
        members = [i for i, own in enumerate(self.class_of) if own == c]
        pairs = [
            np.stack((runs, np.full(len(runs), i)))
            for i in members
            for runs in [np.unique(self._coded(np.array(self.items[i], np.int64), q))]
        ]
        runs, items = np.concatenate(pairs, axis=1)
        order = np.argsort(runs, kind="stable")
        distinct, firsts = np.unique(runs[order], return_index=True)
        return distinct, np.append(firsts, len(order)), items[order]

    def _by_runs(
        self, c: int, text: np.ndarray, starts: np.ndarray
    ) -> Iterator[tuple[int, int]]:
        """(start, item) of the items of a class with enough runs in a window from there.

        A window stays at a start until it has moved half a window, and is half a window
        longer, so that no place is counted more than a few times.
        """
        q, _, span = self.filters[c]
        distinct, firsts, items = self.posted[c]
        needed = np.full(len(self.items), len(text) + 1)
        for i, own in enumerate(self.class_of):
            if own == c:
                needed[i] = max(1, len(self.items[i]) - q + 1 - q * self.limits[i])
        step, at = max(1, span // 2), 0
        while at < len(starts):
            first = int(starts[at])
            at_next = int(np.searchsorted(starts, first + step, "left"))
            last = int(starts[at_next - 1])
            codes = self._coded(text[first : last + span], q)
            codes = codes[codes >= 0]
            place = np.minimum(np.searchsorted(distinct, codes), len(distinct) - 1)
            times = np.zeros(len(self.items), np.int64)
            for run in place[distinct[place] == codes].tolist():
                times[items[firsts[run] : firsts[run + 1]]] += 1
            for item in np.nonzero(times >= needed)[0].tolist():
                yield last, item
                for start in range(first, last, max(1, self.limits[item])):
                    yield start, item
            at = at_next

    def _edited(self, words: list[int], edits: int, random: np.random.Generator) -> list[int]:
        out = list(words)
        for _ in range(edits):
            kind, at = random.integers(3), int(random.integers(max(1, len(out))))
            if kind == 0 and out:
                out[at] = self.strange
            elif kind == 1 and out:
                del out[at]
            else:
                out.insert(at, self.strange)
        return out

    def _walks_for_recall(self, c: int, trials: int = 400) -> int | None:
        """How many walks find the wanted share of a class at its largest distances.

        Measured on edited copies of items followed by other words. None if they would
        be more than the most.
        """
        random = np.random.default_rng(self.settings.seed + 1)
        members = [i for i, own in enumerate(self.class_of) if own == c]
        chosen = [members[int(random.integers(len(members)))] for _ in range(trials)]
        edited = [self._edited(self.items[i], self.limits[i], random) for i in chosen]
        distinct, which = np.unique(chosen, return_inverse=True)
        laid, item_starts = self._laid([self.items[i] for i in distinct])
        text, starts = self._laid(edited)
        starts = np.concatenate((item_starts, starts + len(laid)))
        text = np.concatenate((laid, text))
        missed = np.ones(trials, bool)
        allowed = (1 - self.settings.recall) * trials
        for walk in range(self.most_walks):
            (hashes,) = self._hashes(walk, text, starts, [c])
            missed &= hashes[len(distinct) :] != hashes[: len(distinct)][which]
            count = int(missed.sum())
            if count <= int(allowed):
                return walk + 1
            # The more walks, the less a further one finds, so the misses stay above this.
            least = trials * (count / trials) ** (self.most_walks / (walk + 1))
            if walk >= 19 and least > allowed:
                return None
        return None

    def candidates(self, texts: list[list[str]]) -> Iterator[tuple[int, int, int]]:
        """(text, item, start): windows and items with an equal hash."""
        if not self.items:
            return
        symbols = [
            np.fromiter(map(self.vocabulary.get, words, repeat(self.strange)), np.int64, len(words))
            for words in texts
        ]
        text, firsts = self._laid(symbols)
        masks = self._windows(text)
        starts = np.nonzero(np.logical_or.reduce(masks))[0]
        if not len(starts):
            return
        fits = [mask[starts] for mask in masks]
        seen: set[tuple[int, int]] = set()

        def new(start: int, item: int) -> Iterator[tuple[int, int, int]]:
            if (start, item) not in seen:
                seen.add((start, item))
                which = int(np.searchsorted(firsts, start, "right")) - 1
                yield which, item, start - int(firsts[which])

        classes: list[int] = []
        for walk in range(self.walks):
            table, order = self.tables[walk]
            if classes != self._walking(walk):
                classes = self._walking(walk)
                some = np.logical_or.reduce([fits[c] for c in classes])
                own_starts = starts[some]
                own_fits = {c: fits[c][some] for c in classes}
            if not len(own_starts):
                continue
            for c, hashes in zip(classes, self._hashes(walk, text, own_starts, classes)):
                here = np.nonzero(own_fits[c])[0]
                low = np.searchsorted(table, hashes[here], "left")
                high = np.searchsorted(table, hashes[here], "right")
                for place in np.nonzero(high > low)[0]:
                    start = int(own_starts[here[place]])
                    for item in order[low[place] : high[place]].tolist():
                        yield from new(start, item)
        for c in self.posted:
            for start, item in self._by_runs(c, text, starts[fits[c]]):
                yield from new(start, item)

    def matches(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, end word) of each text and item, the best run."""
        split = [words_of(text) for text in texts]
        found: dict[tuple[int, int], set[int]] = defaultdict(set)
        for which, item, start in self.candidates(split):
            found[which, item].add(start)
        for (which, item), starts in sorted(found.items()):
            words, pattern, limit = split[which], self.items[item], self.limits[item]
            best: tuple[int, int] | None = None
            verified = -1
            for start in sorted(starts):
                low = max(0, start - limit)
                high = min(len(words), start + len(pattern) + 2 * limit + 1)
                if high <= verified:
                    continue  # that region has been searched
                verified = high
                region = [self.vocabulary.get(w, self.strange) for w in words[low:high]]
                match = edit_match(pattern, region, limit)
                if match and (best is None or match[0] < best[0]):
                    best = match[0], low + match[1]
            if best:
                # The same alignment backwards from its end gives its first word.
                back = words[max(0, best[1] - len(pattern) - limit) : best[1]][::-1]
                symbols = [self.vocabulary.get(w, self.strange) for w in back]
                length = _shortest_suffix(pattern[::-1], symbols, best[0])
                yield which, item, best[0], best[1] - length, best[1]
        if self.short:
            for which, words in enumerate(split):
                yield from self._short_matches(which, words)

    def _short_matches(
        self, which: int, words: list[str]
    ) -> Iterator[tuple[int, int, int, int, int]]:
        """The first exact run of each short item in a text."""
        seen: set[tuple[str, ...]] = set()
        for at, word in enumerate(words):
            if word in self.short_firsts:
                for length in self.short_lengths:
                    run = tuple(words[at : at + length])
                    if len(run) == length and run in self.short and run not in seen:
                        seen.add(run)
                        for item in self.short[run]:
                            yield which, len(self.items) + item, 0, at, at + length


def _shortest_suffix(pattern: list[int], text: list[int], distance: int) -> int:
    """How many first symbols of ``text`` have this edit distance to ``pattern``."""
    row = list(range(len(pattern) + 1))
    if row[-1] == distance:
        return 0
    for at, symbol in enumerate(text, 1):
        last, row = row, [at]
        for i, own in enumerate(pattern, 1):
            row.append(min(last[i] + 1, row[-1] + 1, last[i - 1] + (own != symbol)))
        if row[-1] == distance:
            return at
    return len(text)


def item_blocks(
    benchmark: DataFrame, settings: Settings = Settings(), fields: Fields = Fields("item_id")
) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about ``block_bytes`` of text.

    Items without a key or a text are left out. A block is what one search needs on
    the driver and in a task, so memory does not follow the benchmark's size.
    """
    items = keyed_texts(benchmark, fields).filter("key is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // settings.block_bytes))
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == block)
        yield [(r["key"], r["text"]) for r in own.distinct().orderBy("key", "text").collect()]


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    fields: Fields = Fields(),
    item_fields: Fields = Fields("item_id"),
    settings: Settings = Settings(),
) -> DataFrame:
    """(key, item, distance, first_word, end_word): every document with every item in it.

    One row per document row and item, with the best run of words. Null texts have no
    words. No shuffle; the documents are read once for each block of items.
    """
    source = keyed_texts(docs, fields)
    kind = source.schema["key"].dataType.simpleString()
    item_kind = benchmark.schema[item_fields.key].dataType.simpleString()
    schema = f"key {kind}, item {item_kind}, distance int, first_word int, end_word int"
    found = None
    for items in item_blocks(benchmark, settings, item_fields):
        search = Walks(items, settings)

        def run(batches, search=search):
            for batch in batches:
                for part in slices(batch, "text"):
                    keys = part.column("key").to_pylist()
                    rows = [
                        (keys[which], search.keys[item], *rest)
                        for which, item, *rest in search.matches(texts_of(part))
                    ]
                    names = ["key", "item", "distance", "first_word", "end_word"]
                    kinds = [part.schema.field("key").type, None, pa.int32(), pa.int32(), pa.int32()]
                    columns = list(zip(*rows)) if rows else [()] * 5
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(columns, kinds)], names
                        )

        part = source.mapInArrow(run, schema)
        found = part if found is None else found.unionAll(part)
    return found


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    fields: Fields = Fields(),
    item_fields: Fields = Fields("item_id"),
    settings: Settings = Settings(),
    folder: str | None = None,
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, in which no item is found.

    A benchmark of one block is a filter without a shuffle. With more blocks a task holds
    one at a time: rows are staged with a number in ``folder`` (one of its own, if none is
    given), each block's search leaves the numbers of the rows it finds, and these rows are
    left out at the end.
    """
    blocks = item_blocks(benchmark, settings, item_fields)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        search = Walks(first, settings)

        def clean(batches):
            for batch in batches:
                for part in slices(batch, fields.text):
                    found = {row[0] for row in search.matches(texts_of(part, fields.text))}
                    mask = [at not in found for at in range(part.num_rows)]
                    yield part.filter(pa.array(mask, pa.bool_()))

        return docs.mapInArrow(clean, docs.schema)
    folder = folder or staging_folder(docs.sparkSession)
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    numbered = stage(
        docs.select(row, F.monotonically_increasing_id().alias("number")), folder, "numbered"
    )
    texts = numbered.select("number", F.col(f"row.`{fields.text}`").alias("text"))
    dirty = None
    for at, items in enumerate(chain([first, second], blocks)):
        search = Walks(items, settings)

        def numbers(batches, search=search):
            for batch in batches:
                for part in slices(batch, "text"):
                    found = sorted({which for which, *_ in search.matches(texts_of(part))})
                    yield part.select(["number"]).take(pa.array(found, pa.int64()))

        part = stage(texts.mapInArrow(numbers, "number bigint"), folder, f"dirty_{at}")
        dirty = part if dirty is None else dirty.unionAll(part)
    kept = numbered.join(dirty, "number", "left_anti")
    return kept.select(*[F.col(f"row.`{name}`") for name in docs.columns])
