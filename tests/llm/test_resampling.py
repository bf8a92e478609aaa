from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from shopledger.llm import queries, resampling
from shopledger.llm.batches import Fields
from shopledger.llm.oracle import ORACLE
from shopledger.llm.resampling import Features
from tests.conftest import bag
from tools.compare import differences, oracle_connection

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER))


def plain_buckets(text: str | None, features: Features) -> list[int]:
    words = plain_words(text)
    return [
        crc32(" ".join(words[i : i + n]).encode()) % features.buckets
        for n in range(1, features.ngrams + 1)
        for i in range(len(words) - n + 1)
    ]


def plain_resample(docs, target, features, percent, min_words, seed):
    """Rows (key, n_words, n_features, weight, score, rank), from whole texts."""
    s = Counter(b for _, text in docs for b in plain_buckets(text, features))
    t = Counter(b for text in target for b in plain_buckets(text, features))
    big_s, big_t, k = sum(s.values()), sum(t.values()), features.buckets
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (big_s + k) / ((s[b] + 1) * (big_t + k))))
        for b in s
    }
    rows = []
    for key, text in docs:
        found = plain_buckets(text, features)
        weight = sum(gain[b] for b in found)
        head = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((head + 0.5) / 2**32)))
        rows.append((key, len(plain_words(text)), len(found), weight, weight + noise))
    ready = [r for r in rows if r[1] >= min_words]
    ready.sort(key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = ready[: percent * len(ready) // 100]
    ranks = iter(range(1, len(drawn) + 1))
    out = [(*r, next(ranks)) for r in drawn]
    for r in drawn:
        rows.remove(r)
    return sorted(out + [(*r, None) for r in rows], key=repr)


def texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    words = ["Alpha", "beta", "ÄRGER", "x1", "", "  ", "-", "京都", "\r", "The", "the"]
    shared = [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(12)]
    return [
        "\n".join(
            rng.choice(shared) if rng.random() < 0.6 else " ".join(rng.choices(words, k=rng.randint(0, 6)))
            for _ in range(rng.randint(0, 8))
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("ngrams", [1, 2, 3, 4])
def test_equals_brute_force(spark, tmp_path, ngrams):
    docs = [(i, text) for i, text in enumerate(texts(150, seed=ngrams))]
    docs += [(7, docs[7][1]), (8, "other text"), (None, docs[3][1]), (900, None), (901, "")]
    target = [*texts(15, seed=77), None, ""]
    features = Features(ngrams, 101)
    found = resampling.resample(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string"),
        str(tmp_path),
        features=features,
        percent=30,
        min_words=3,
        seed=5,
    )
    assert bag(found) == plain_resample(docs, target, features, 30, 3, 5)


def test_odd_columns_and_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "a b c", 5, 2), (2, None, 6, None)], "id long, body string, row long, `n weight` long"
    )
    target = spark.createDataFrame([], "item_id long, text string")
    how = {"fields": Fields("id", "body"), "min_words": 1, "percent": 100}
    found = resampling.resample(docs, target, f"{tmp_path}/a", **how)
    assert [(r.key, r.n_features, r["rank"]) for r in found.orderBy("key").collect()] == [
        (1, 5, 1), (2, 0, None)
    ]
    assert resampling.resample(docs.limit(0), target, f"{tmp_path}/b", **how).count() == 0
    with pytest.raises(ValueError):
        Features(0)


def test_a_line_of_most_texts_is_merged_before_the_shuffle(spark, tmp_path):
    docs = spark.range(0, 4000, numPartitions=4).selectExpr(
        "id as doc_id", "concat('one shared line of words\n', if(id % 3 = 0, 'more', string(id))) as text"
    )
    counted = resampling.count_features(docs, str(tmp_path), "x", Features(1, 50))
    hot = counted.lines.filter("n_words = 5").collect()
    assert [(row.occurrences, row.n) for row in hot] == [(4000, 5)]
    assert resampling.bucket_counts(counted).sum() == 4000 * 6


def test_same_rows_as_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = oracle_connection(folder)
    found = queries.QUERIES["op11_resampling"](spark, folder)
    assert differences(found, con, ORACLE["op11_resampling"]) is None
