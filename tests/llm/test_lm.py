from __future__ import annotations

import random
from collections import Counter
from math import log2, log10

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from shopledger.llm import lm
from shopledger.sources.staging import staging_folder

BEGIN, END = b"<begin>", b"<end>"
WEIGHTS = tuple(tuple(0.2 + 0.01 * level * n for level in range(lm.LEVELS)) for n in (1, 2))


def tokens(text: str | None) -> list[bytes]:
    return [BEGIN, *(text or "").encode().lower().split(), END]


class Plain:
    """The model by its definition, with counts in dictionaries."""

    def __init__(self, texts, weights, order=3):
        self.weights, self.order = weights, order
        self.counts = Counter()
        for text in texts:
            ts = tokens(text)
            for n in range(1, order + 1):
                self.counts.update(tuple(ts[i : i + n]) for i in range(len(ts) - n + 1))
        unigrams = {g: c for g, c in self.counts.items() if len(g) == 1 and g != (BEGIN,)}
        self.n, self.v = sum(unigrams.values()), len(unigrams)

    def p(self, word, context=()):
        if not context:
            return (self.counts[(word,)] + 0.5) / (self.n + 0.5 * (self.v + 1))
        shorter = self.p(word, context[1:])
        seen = self.counts[context]
        if not seen:
            return shorter
        weight = self.weights[len(context) - 1][int(log2(seen))]
        return weight * self.counts[(*context, word)] / seen + (1 - weight) * shorter

    def score(self, text):
        ts = tokens(text)
        return sum(
            log10(self.p(ts[i], tuple(ts[max(0, i - self.order + 1) : i]))) for i in range(1, len(ts))
        )

    def base(self, text):
        return sum(log10(self.p(t)) for t in tokens(text)[1:])


def corpus(n: int, seed: int = 0):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for key in range(n):
        words = rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(60)], k=rng.randint(0, 60))
        if key % 4 == 0:
            words += "a phrase that comes Again and again".split()
        if key % 7 == 0:
            words.append(f"rare{key}")
        rows.append((key, rng.choice([" ", "\t\n"]).join(words)))
    return rows


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_by_definition(spark, order):
    weights = tuple(WEIGHTS[0] for _ in range(order - 1))
    rows = [*corpus(80), (900, None), (901, ""), (902, "A a É é"), (903, "unseen words only here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    settings = lm.Settings(order=order, block_bytes=1500, blocks_per_slice=2)
    found = lm.score(docs, F.col("doc_id") % 5 != 1, staging_folder(spark), settings=settings, weights=weights)
    plain = Plain([t for k, t in rows if k % 5 != 1], weights, order)
    texts = dict(rows)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["key"]]
        assert r["score"] == pytest.approx(plain.score(text), rel=1e-9)
        assert r["base_score"] == pytest.approx(plain.base(text), rel=1e-9)
        assert r["train_tokens"] == plain.n and r["n_tokens"] == len(tokens(text)) - 1
        assert r["n_known"] == sum(plain.counts[(t,)] > 0 for t in tokens(text)[1:])


def test_probabilities_of_a_context_sum_to_one():
    plain = Plain([t for _, t in corpus(40)], WEIGHTS)
    words = {g[0] for g in plain.counts if len(g) == 1} - {BEGIN}
    for context in list(plain.counts)[:200]:
        if len(context) < 3 and END not in context:
            total = sum(plain.p(w, context) for w in words) + plain.p(b"unseen", context)
            assert total == pytest.approx(1)


def test_fitted_weights_beat_the_base_on_held_out_texts(spark):
    docs = spark.createDataFrame(corpus(400), "doc_id long, text string")
    held_out = F.col("doc_id") % 5 == 1
    found = lm.score(docs, ~held_out, staging_folder(spark)).filter("not train")
    base, score = found.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > 0.96 * base


def test_fit_weight_finds_the_mixture():
    times = np.zeros(lm.RATIOS)
    times[0], times[lm.RATIOS - 1] = 300, 700
    assert 0.69 < lm.fit_weight(times) < 0.72


def test_packing_round_trips():
    rng = np.random.default_rng(0)
    for most in (1, 200, 60_000, 2**31, 2**62):
        numbers = rng.integers(0, most, 100)
        assert (lm._unpacked(lm._packed(numbers)) == numbers).all()
        hashes = np.sort(rng.integers(0, most, 100).astype(np.uint64))
        assert (lm._unpacked_hashes(lm._packed_hashes(hashes)) == hashes).all()
    assert len(lm._unpacked(lm._packed(np.zeros(0, np.int64)))) == 0


def test_edge_cases(spark):
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (2, None), (3, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "'x' AS key", "*", "1 AS train", "2 AS block", "3 AS row"
    )
    found = lm.score(docs, F.col("doc_id") > 0, staging_folder(spark))
    got = found.collect()
    assert len(got) == len(rows)
    assert {r["train"] for r in got if r["key"] is None} == {False}
    assert {r["train_tokens"] for r in got} == {3 + 3 + 1 + 30_001}
    untrained = lm.score(docs, F.lit(False), staging_folder(spark)).collect()
    assert {(r["n_known"], r["train_tokens"], r["score"], r["base_score"]) for r in untrained} == {
        (0, 0, 0.0, 0.0)
    }
    assert lm.score(docs.limit(0), F.lit(True), staging_folder(spark)).count() == 0


def test_block_texts_count_training_texts_only():
    rows = pa.table(
        {"row": [1, 0], "key": [7, 8], "text": ["a b a b", "b a"], "train": [True, False]}
    )
    texts = lm.BlockTexts(rows, 2)
    assert texts.keys.to_pylist() == [8, 7]
    bigrams = texts.grams[1]
    words = {n: w for w, n in {b"end": 0, b"begin": 1, b"b": 2, b"a": 3}.items()}
    seen = {
        (words[texts.grams[0].last[p]], words[w]): c
        for p, w, c in zip(bigrams.prefix, bigrams.last, bigrams.counts)
    }
    assert seen == {
        (b"begin", b"a"): 1, (b"a", b"b"): 2, (b"b", b"a"): 1, (b"b", b"end"): 1,
        (b"begin", b"b"): 0, (b"a", b"end"): 0,
    }


def test_weights_are_fitted_on_all_blocks(spark):
    # The first half repeats one phrase, the second never does: no few blocks tell of both.
    rows = [(k, "one two three four " * 12) for k in range(200)]
    rows += [(200 + k, text) for k, text in corpus(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = []
    for block_bytes in (500, 1 << 20):
        settings = lm.Settings(block_bytes=block_bytes)
        found = lm.score(docs, F.lit(True), staging_folder(spark), settings=settings)
        got.append({r["key"]: r["score"] for r in found.collect()})
    assert got[0] == pytest.approx(got[1], rel=1e-9)


def test_texts_side_by_side_carry_their_states(monkeypatch):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(9)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 7, 40, 300]))) for _ in range(60)]
    rows = pa.table({
        "row": list(range(60)), "key": list(range(60)), "text": texts,
        "train": [i % 3 > 0 for i in range(60)],
    })
    for order in (1, 2, 3, 4):
        block = lm.BlockTexts(rows, order)
        counts = [g.counts.astype(np.int64) for g in block.grams]
        mixture = lm.Mixture(5000, 9, tuple(WEIGHTS[0] for _ in range(order - 1)))
        automaton = lm.Automaton(block, counts, mixture)
        weights, targets = (dict(zip(automaton.arcs.tolist(), x.tolist())) for x in (automaton.weights, automaton.targets))
        plain = []
        for start, end in zip(block.starts + 1, block.ends):
            state, total = automaton.begin, 0.0
            for word in block.text[start:end].tolist():
                while state * automaton.n_words + word not in weights:
                    total += automaton.fail_weight[state]
                    state = int(automaton.fail_to[state])
                arc = state * automaton.n_words + word
                total, state = total + weights[arc], targets[arc]
            plain.append(total)
        for stretch in (1, 2, 5, 256):
            monkeypatch.setattr(lm, "STRETCH", stretch)
            found = automaton.score(block.text, block.starts + 1, block.ends)
            assert found == pytest.approx(plain, rel=1e-9, abs=1e-12)


def test_packed_blocks_are_the_texts(spark, tmp_path):
    rows = [(1, "B a b", True), (None, None, False), (3, "", True), (4, "a" * 9000 + " x", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t boolean").coalesce(1)
    settings = lm.Settings(block_bytes=4000)
    blocks = lm.in_blocks(docs, F.col("t"), str(tmp_path), "lm_test_blocks", settings=settings)
    found = sorted(blocks.toArrow().to_pylist(), key=lambda row: row["block"])
    assert [key for row in found for key in row["keys"]] == [1, None, 3, 4]
    for row in found:
        block = lm.BlockTexts.of(pa.table({n: [v] for n, v in row.items()}), 2, settings)
        own = [r for r in rows if r[0] in row["keys"]]
        plain = lm.BlockTexts(
            pa.table({"row": range(len(own)), "key": [r[0] for r in own], "text": [r[1] for r in own],
                      "train": [r[2] for r in own]}), 2)
        for a, b in zip(block.grams, plain.grams):
            assert (a.hashes == b.hashes).all() and (a.counts == b.counts).all() and (a.at == b.at).all()
    spark.sql("DROP TABLE lm_test_blocks")


def test_no_table_stays_in_the_catalog(spark):
    docs = spark.createDataFrame(corpus(30), "doc_id long, text string")
    found = lm.score(docs, F.lit(True), staging_folder(spark))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lm_")]
    assert found.count() == 30


def test_rows_sent_grow_with_the_text_until_slices_multiply(spark, tmp_path):
    """Eight and sixty-four blocks: a block sends each slice one row an order."""
    for blocks, copies in ((8, 1), (64, 8)):
        docs = spark.createDataFrame(corpus(80) * copies, "doc_id long, text string").coalesce(1)
        size = sum(len(t) for _, t in corpus(80) * copies) // blocks
        settings = lm.Settings(block_bytes=size, blocks_per_slice=64)
        made = lm.in_blocks(docs, F.lit(True), f"{tmp_path}/{blocks}", f"lm_rows_{blocks}", settings=settings)
        n = made.count()
        slices = max(1, -(-n // settings.blocks_per_slice))
        assert lm._asked(made, None, (1, 2), slices, settings).count() <= 2 * n * slices
        assert slices <= 2
        spark.sql(f"DROP TABLE lm_rows_{blocks}")
