from __future__ import annotations

import random

import numpy as np
import xxhash

from shopledger.llm import golay, simhash
from shopledger.llm.batches import Fields
from shopledger.llm.components import components
from shopledger.sources.staging import staging_folder


def plain_fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows: list[tuple[int, str | None]], bits: int = 2) -> dict[int, int]:
    prints = {key: plain_fingerprint(text) for key, text in rows}
    root = {key: key for key in prints}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= bits:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {key: find(key) for key in prints}


def corpus(seed: int = 1, n: int = 60) -> list[tuple[int, str | None]]:
    """Texts with copies, near copies, and awkward ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows: list[tuple[int, str | None]] = []
    for key in range(n):
        words = rng.choices(vocabulary, k=rng.randint(1, 400))
        rows.append((key * 10 + 5, " ".join(words)))
        if key % 3 == 0:
            rows.append((key * 10 + 3, " ".join(words).upper().replace(" ", "\t ")))
        if key % 4 == 0 and len(words) > 150:
            words[rng.randrange(len(words))] = "changed"
            rows.append((key * 10 + 7, " ".join(words)))
    rows += [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "one"), (9005, "one two"), (9006, "ONE")]
    return rows


def test_golay_keys_meet_at_one_error():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 500)
    for bit in range(23):
        for a, b in zip(golay.codeword_keys(words), golay.codeword_keys(words ^ (1 << bit))):
            assert set(a) & set(b)


def test_fuzzy_keys_meet_at_two_errors():
    rng = np.random.default_rng(1)
    prints = rng.integers(-(2**63), 2**63, 40, dtype=np.int64)
    for i in range(64):
        for j in range(i, 64):
            near = (prints.view(np.uint64) ^ np.uint64((1 << i) | (1 << j))).view(np.int64)
            for a, b in zip(simhash.fuzzy_keys(prints), simhash.fuzzy_keys(near)):
                assert set(a.tolist()) & set(b.tolist())


def test_fingerprint_by_definition():
    for _, text in corpus():
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)
    # Only A-Z are lower-cased and only ASCII white space parts words.
    assert simhash.fingerprint("É x y") == plain_fingerprint("É x y")
    assert simhash.fingerprint("A") == simhash.fingerprint("a") != simhash.fingerprint("é")


def test_components_of_a_path_a_star_and_a_cycle(spark):
    links = [(i, i + 1) for i in range(100, 140)]
    links += [(1, i) for i in range(2, 40)]
    links += [(200, 201), (201, 202), (200, 202), (200, 202)]
    found = components(spark.createDataFrame(links, "a long, b long"), staging_folder(spark))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert roots == (
        {i: 100 for i in range(101, 141)} | {i: 1 for i in range(2, 40)} | {201: 200, 202: 200}
    )


def test_near_duplicates_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(
        [(text, key, 1, "x") for key, text in rows], "text string, id long, key int, component string"
    )
    found = simhash.near_duplicates(docs, staging_folder(spark), Fields("id")).collect()
    assert {r["key"]: r["component"] for r in found} == plain_components(rows)
    assert len(found) == len(rows)
    prints = dict(rows)
    for r in found:
        assert r["fingerprint"] % (1 << 64) == plain_fingerprint(prints[r["key"]])


def test_links_are_all_pairs_within_two_bits(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(50)}
    for p in list(prints)[:25]:
        for bits in (1, 2, 2, 3):
            q = p
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    found = {(r["a"], r["b"]) for r in simhash.links(table).collect()}
    expected = {
        (a, b)
        for a in signed
        for b in signed
        if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2
    }
    assert found == expected


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d"), (3, "A b c d"), (4, "a b c d"), (3, "a b c d"), (None, "a b c d")]
    rows += [(None, "lonely words here"), (None, "lonely words here"), (8, None), (7, "")]
    rows += [(20, "key twice, first text"), (20, "key twice, other text entirely")]
    docs = spark.createDataFrame(
        [(t, k, "extra", 0) for k, t in rows], "text string, doc_id long, key string, fingerprint int"
    )
    kept = simhash.keep_one_of_each(docs, staging_folder(spark))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], (r["text"] or "").lower()) for r in kept.collect()), key=repr) == sorted(
        [
            (3, "a b c d"),
            (None, "lonely words here"),
            (7, ""),
            (20, "key twice, first text"),
            (20, "key twice, other text entirely"),
        ],
        key=repr,
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs, staging_folder(spark)).count() == 0
    assert simhash.keep_one_of_each(docs, staging_folder(spark)).count() == 0


def test_odd_column_names_stay(spark):
    rows = [(1, "same words here again", 1, "p", 9), (2, "same words here again", 2, "q", 8),
            (2, "same words here again", 3, "r", 7), (None, "other words of a text", 4, "s", 6)]
    docs = spark.createDataFrame(rows, "key long, `my col` string, `a-b` int, `row` string, `c.d` int")
    kept = simhash.keep_one_of_each(docs, staging_folder(spark), simhash.Fields("key", "my col"))
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect() if r[0] is not None) == [rows[0]]
    assert [tuple(r) for r in kept.collect() if r[0] is None] == [rows[3]]
