from __future__ import annotations

import hashlib
import json
import random
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopledger.llm import bpe, queries
from shopledger.llm.batches import Fields

PATH = public_tokenizers.path("byte_bpe_50k.json")
CONTENT = Path(PATH).read_bytes()
LIBRARY = Tokenizer.from_file(PATH)
MODEL = bpe.ByteBpe(CONTENT)


def encoded(model: bpe.ByteBpe, some: list[str]) -> list[list[int]]:
    ids, counts = model.encode(some)
    out, at = [], 0
    for n in counts.tolist():
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def texts(n: int, seed: int = 0) -> list[str]:
    rng = random.Random(seed)
    letters = "aabcdethingéЖ京😀XYZ 012-_'“”<>=\n\t  \x85\x1c "
    anywhere = [rng.choice((rng.randrange(0xD800), rng.randrange(0xE000, 0x110000))) for _ in range(40 * n)]
    return (
        ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(n)]
        + ["".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(n)]
        + ["".join(map(chr, anywhere[i : i + 20])) for i in range(0, len(anywhere), 20)]
    )


ODD = [
    "", "<|endoftext|>", "a<|endoftext|> <|endoftext|><|endoftext|>b  <|endoftext|>", "<|endoftext",
    "x" * 5000, "=" * 777, "ab" * 3000, " " * 999 + "a", "\n" * 55, "don't we'll I'M", "�",
]


def test_equals_the_library():
    some = [*texts(1500), *ODD]
    found = encoded(MODEL, some)
    assert found == [e.ids for e in LIBRARY.encode_batch(some, add_special_tokens=False)]
    assert [MODEL.decode(ids) for ids in found] == some
    assert [LIBRARY.decode(ids, skip_special_tokens=False) for ids in found] == some


def test_decoding_of_broken_bytes():
    rng = random.Random(5)
    for _ in range(300):
        ids = rng.choices(range(50_257), k=8) + rng.choices(range(130, 256), k=5)
        assert MODEL.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert MODEL.decode([999_999]) == ""


def test_words_are_cut_as_by_the_library():
    cutter = LIBRARY.pre_tokenizer
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 512):
        text = "".join(f"a{chr(c)}1{chr(c)}! {chr(c)}" for c in points[start : start + 512])
        assert MODEL.words_of(text) == [text[a:b] for _, (a, b) in cutter.pre_tokenize_str(text)]


def plain_merges(word: bytes, merges: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    parts = [bytes([b]) for b in word]
    while True:
        ranked = [(merges[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
        if not ranked:
            return parts
        at = min(ranked)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def small_model(merges: list[tuple[str, str]]) -> bytes:
    letters = list(bpe.byte_letters())
    vocabulary = {ch: at for at, ch in enumerate(letters)}
    for a, b in merges:
        vocabulary.setdefault(a + b, len(vocabulary))
    spec = json.loads(CONTENT)
    spec["model"] |= {"vocab": vocabulary, "merges": [list(pair) for pair in merges]}
    spec["added_tokens"] = []
    return json.dumps(spec).encode()


def test_random_models_by_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 12:
            pair = rng.choice(tokens), rng.choice(tokens)
            if pair[0] + pair[1] not in tokens:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        model = bpe.ByteBpe(small_model(merges))
        ranks = {(a.encode(), b.encode()): rank for rank, (a, b) in enumerate(merges)}
        words = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 14))) for _ in range(200)})
        for word, ids in zip(words, model.encode_words(words)):
            assert [model.surface[i] for i in ids] == plain_merges(word, ranks)


def test_unsupported_models_are_refused():
    for change in (
        {"normalizer": {"type": "NFC"}},
        {"pre_tokenizer": {"type": "Whitespace"}},
        {"added_tokens": [{"id": 1, "content": "x", "lstrip": True}]},
    ):
        with pytest.raises(ValueError):
            bpe.ByteBpe(json.dumps(json.loads(CONTENT) | change).encode())
    with pytest.raises(ValueError):
        bpe.ByteBpe(small_model([("ab", "c"), ("a", "b")]))


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a b", "y"), (2, "", None), (3, "é" * 40_000, "z")]
    docs = spark.createDataFrame(rows, "id long, body string, `n_tokens` string")
    found = bpe.encode(docs, CONTENT, Fields("id", "body"), decoded=True)
    assert found.columns == ["key", "n_tokens", "ids", "decoded"]
    by_text = {row.decoded: (row.key, row.n_tokens, row.ids) for row in found.collect()}
    assert found.filter("key = 1 and n_tokens = 0 and decoded = ''").count() == 2
    for text in ("a b", "é" * 40_000):
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert by_text[text][1:] == (len(ids), ids)
    assert bpe.encode(docs.limit(0), CONTENT, Fields("id", "body")).count() == 0


def test_query_equals_the_library(spark, tmp_path):
    rows = [(i, text) for i, text in enumerate([*texts(60, seed=9), *ODD, None])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = {row.doc_id: row for row in queries.op13_byte_bpe(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for key, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert found[key].n_tokens == len(ids)
        digests = [",".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False)]
        assert [found[key].ids_sha256, found[key].decoded_sha256] == [
            hashlib.sha256(x.encode()).hexdigest() for x in digests
        ]
