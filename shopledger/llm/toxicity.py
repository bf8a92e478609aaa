"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts and terms are folded to one skeleton (case, look-alike letters, digits written
for letters), so disguised spellings match. A term is a whole word or a stem that a
word begins with. Matches inside an exception phrase do not count. A text's weights
are summed, divided by its length in words, and mapped to 0..1 by a fitted logistic.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from math import exp, log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.batches import Fields, keyed_texts, slices, texts_of
from shopledger.sources.staging import stage

# Characters commonly written for a Latin letter, as (written, meant).
DIGITS = ("0134578@$", "oieastbas")
CYRILLIC = ("авеёіјкмнорстухѕԁһӏ", "abeeijkmhopctyxsdhi")
GREEK = ("αβεικνορτυχ", "abeiknoptux")
# Letters that look alike in some scripts and fonts share a skeleton.
SAME = ("l|", "ii")


def _fold_table() -> dict[int, str]:
    table = {}
    for written, meant in (DIGITS, CYRILLIC, GREEK, SAME):
        table.update({ord(w): m for w, m in zip(written, meant)})
    # Full-width and mathematical letters stand for their compatibility form.
    for code in (*range(0xFF10, 0xFF5B), *range(0x1D400, 0x1D800)):
        plain = unicodedata.normalize("NFKC", chr(code)).lower()
        if len(plain) == 1 and plain.isascii():
            table[code] = plain.translate(str.maketrans(*DIGITS))
    # What stands for a letter with a shared skeleton gets that skeleton.
    return {code: to.translate(str.maketrans(*SAME)) for code, to in table.items()}


_FOLD = _fold_table()


def fold(text: str) -> str:
    """The skeleton of a text; as long as the lower-cased text."""
    return text.lower().translate(_FOLD)


_WORD = re.compile(r"[^\W_]+")

WHOLE = "\n"  # ends a term that must be a whole word


@dataclass(frozen=True)
class Settings:
    """Bounds of the fitted sample and of the lexicon.

    At most ``sample_texts`` texts of each label are read for fitting. A term needs
    ``min_share`` of the sampled toxic texts, and ``min_texts`` at least, and a
    log-odds of ``min_log_odds``.
    """

    sample_texts: int = 4096
    min_texts: int = 8
    min_share: float = 0.005
    min_log_odds: float = 3.0
    stem_lengths: tuple[int, ...] = (4, 5, 6)
    max_term: int = 24
    prior_words: float = 20.0
    max_exceptions: int = 1000


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    slope: float = 1.0
    offset: float = 0.0
    prior_words: float = 20.0


def terms_of(text: str, settings: Settings) -> set[str]:
    """The candidate terms of a text: its words and their stems, folded."""
    found = set()
    for word in set(_WORD.findall(fold(text))):
        if len(word) <= settings.max_term:
            found.add(word + WHOLE)
        found.update(word[:n] for n in settings.stem_lengths if len(word) > n)
    return found


class Scorer:
    """The automaton of a model; made once per task."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = None
        if not model.weights:
            return
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for term, weight in model.weights.items():
            word = term.rstrip(WHOLE)
            entries.setdefault(word, []).append((len(word), weight, term.endswith(WHOLE)))
        for phrase in model.exceptions:
            entries.setdefault(fold(phrase), []).append((len(fold(phrase)), None, True))
        for word, found in entries.items():
            self.automaton.add_word(word, tuple(found))
        self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the words that count, by position in the folded text."""
        if self.automaton is None:
            return []
        folded = fold(text)
        best: dict[int, tuple[int, float]] = {}
        excused: list[tuple[int, int]] = []
        for last, found in self.automaton.iter(folded):
            for length, weight, whole in found:
                start, end = last - length + 1, last + 1
                if start and folded[start - 1].isalnum():
                    continue
                if whole and end < len(folded) and folded[end].isalnum():
                    continue
                if weight is None:
                    excused.append((start, end))
                elif start not in best or weight > best[start][1]:
                    best[start] = (end, weight)
        if not excused:
            return [(start, *rest) for start, rest in best.items()]
        excused.sort()
        starts = np.array([s for s, _ in excused])
        ends = np.maximum.accumulate([e for _, e in excused])
        counted = []
        for start, (end, weight) in best.items():
            at = int(np.searchsorted(starts, start, side="right")) - 1
            if at < 0 or ends[at] < end:
                counted.append((start, end, weight))
        return counted

    def density(self, text: str) -> tuple[float, int]:
        """Weight per word, with prior words against very short texts, and the hits."""
        hits = self.hits(text)
        if not hits:
            return 0.0, 0
        return sum(h[2] for h in hits) / (len(text.split()) + self.model.prior_words), len(hits)

    def score(self, density: float) -> float:
        z = self.model.slope * density + self.model.offset
        return 1 / (1 + exp(-min(max(z, -500.0), 500.0)))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, fields: Fields, settings: Settings
) -> DataFrame:
    """(key, label, text) of at most ``sample_texts`` keys of label 0 and of label 1.

    The keys come from the label table alone: the least hash of each bucket. Of several
    texts with one key the least counts. Copies of a text count once.
    """
    keyed = labels.select(
        F.col(fields.key).alias("key"), F.col(label).cast("int").alias("label")
    ).filter("key is not null and label in (0, 1)")
    hashed = keyed.withColumn("hash", F.xxhash64("key"))
    bucket = F.pmod("hash", F.lit(settings.sample_texts))
    least = hashed.groupBy("label", bucket).agg(F.min("hash").alias("hash")).select("label", "hash")
    # At most 2 * sample_texts rows of two numbers: small enough to broadcast.
    chosen = hashed.join(F.broadcast(least), ["label", "hash"]).select("key", "label").distinct()
    texts = keyed_texts(docs, fields).filter("text is not null")
    found = texts.join(F.broadcast(chosen.limit(2 * settings.sample_texts)), "key")
    one = found.groupBy("key", "label").agg(F.min("text").alias("text"))
    return one.groupBy("label", "text").agg(F.min("key").alias("key")).select("key", "label", "text")


def _counted(texts: DataFrame, function, schema: str) -> DataFrame:
    """Counters of ``function`` over the texts, one per task, summed by term."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for text in texts_of(part):
                    counts.update(function(text))
        names = list(counts)
        for start in range(0, len(names), 50_000):
            some = names[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([counts[n] for n in some], pa.int64())], ["term", "n"]
            )

    return texts.mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("n"))


def _document_counts(texts: DataFrame, function, least: int) -> dict[str, int]:
    found = _counted(texts, function, "term string, n bigint").filter(F.col("n") >= least)
    return {row["term"]: row["n"] for row in found.collect()}


def choose_terms(
    toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, settings: Settings
) -> dict[str, float]:
    """Weights (log-odds) of the terms that mark label 1.

    A term adds nothing, and is left out, if a stem of it weighs about as much.
    """
    weights: dict[str, float] = {}
    for term in sorted(toxic, key=len):
        odds = log((toxic[term] + 0.5) / (n_toxic + 1)) - log(
            (clean.get(term, 0) + 0.5) / (n_clean + 1)
        )
        if odds < settings.min_log_odds:
            continue
        word = term.rstrip(WHOLE)
        stems = [word[:n] for n in settings.stem_lengths if n <= len(word)]
        if all(weights.get(stem, 0.0) < odds - 0.7 for stem in stems if stem != term):
            weights[term] = odds
    return weights


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic, by Newton steps with a small ridge."""
    scale = float(x.max()) or 1.0
    features = np.column_stack((x / scale, np.ones(len(x))))
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (p - y) + 1e-3 * beta
        hessian = features.T @ (features * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def _phrases(text: str, scorer: Scorer) -> Iterable[str]:
    """Two-word phrases around counted words: with the word before and the one after."""
    folded = fold(text)
    starts = {start for start, _, _ in scorer.hits(text)}
    if not starts:
        return set()
    words = [(m.start(), m.end()) for m in _WORD.finditer(folded)]
    found = set()
    for at, (start, end) in enumerate(words):
        if start in starts:
            if at:
                found.add(folded[words[at - 1][0] : end])
            if at + 1 < len(words):
                found.add(folded[start : words[at + 1][1]])
    return found


def fit(
    docs: DataFrame,
    labels: DataFrame,
    folder: str,
    label: str = "toxic",
    fields: Fields = Fields(),
    settings: Settings = Settings(),
) -> Model:
    """Lexicon, exceptions and logistic from a bounded sample of labelled texts.

    Counting runs in Spark over the staged sample; only terms above the thresholds and
    one number per sampled text reach the driver. Without both labels the model scores
    every text 0.5 or below. Null keys, labels and texts are left out.
    """
    rows = stage(sample(docs, labels, label, fields, settings), folder, "toxicity_sample")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model(offset=-1.0, prior_words=settings.prior_words)
    least = max(settings.min_texts, int(settings.min_share * n_toxic))
    toxic, clean = rows.filter("label = 1"), rows.filter("label = 0")
    in_toxic = _document_counts(toxic, lambda text: terms_of(text, settings), least)
    wanted = frozenset(in_toxic)
    in_clean = _document_counts(clean, lambda text: terms_of(text, settings) & wanted, 1)
    weights = choose_terms(in_toxic, in_clean, n_toxic, n_clean, settings)
    draft = Model(weights, (), 1.0, 0.0, settings.prior_words)

    phrases = _document_counts(
        clean, lambda text: _phrases(text, Scorer(draft)), settings.min_texts
    )
    known = frozenset(phrases)
    against = (
        _document_counts(toxic, lambda text: known.intersection(_phrases(text, Scorer(draft))), 1)
        if known
        else {}
    )
    # An exception is a phrase at least four times as common without the label.
    harmless = [
        p for p, n in phrases.items() if n * n_toxic >= 4 * (against.get(p, 0) + 0.5) * n_clean
    ]
    exceptions = tuple(
        sorted(sorted(harmless, key=lambda p: (-phrases[p], p))[: settings.max_exceptions])
    )
    draft = Model(weights, exceptions, 1.0, 0.0, settings.prior_words)
    measured = _densities(rows, draft).select("label", "density").collect()
    slope, offset = fit_logistic(
        np.array([r["density"] for r in measured]), np.array([float(r["label"]) for r in measured])
    )
    return Model(weights, exceptions, slope, offset, settings.prior_words)


def _densities(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [scorer.density(text)[0] for text in texts_of(part)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(found, pa.float64())], ["label", "density"]
                )

    return rows.select("label", "text").mapInArrow(run, "label int, density double")


def score(docs: DataFrame, model: Model, fields: Fields = Fields()) -> DataFrame:
    """(key, score, n_hits, density) of every row, by its whole text alone.

    Null and empty texts score as texts without a hit. Repeated rows stay; other
    columns are ignored.
    """
    source = keyed_texts(docs, fields)
    kind = source.schema["key"].dataType.simpleString()

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [scorer.density(text) for text in texts_of(part)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pa.array([scorer.score(d) for d, _ in found], pa.float64()),
                        pa.array([n for _, n in found], pa.int64()),
                        pa.array([d for d, _ in found], pa.float64()),
                    ],
                    ["key", "score", "n_hits", "density"],
                )

    return source.mapInArrow(run, f"key {kind}, score double, n_hits bigint, density double")
