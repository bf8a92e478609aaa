from __future__ import annotations

import random
from pathlib import Path
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopledger.llm import tokenfiles
from shopledger.llm.batches import Fields
from shopledger.sources.staging import staging_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
CONTENT = Path(PATH).read_text()
END = 2


def texts(n: int, seed: int = 0) -> list[str]:
    rng = random.Random(seed)
    letters = "aAbBsStT  .,\n\t12éÉİß京😀\x1c\x85\xa0́ΣςLL'-_!?#|<>"
    return ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(n)] + [
        "<|startoftext|>a b<|endoftext|>", "x<|ENDOFTEXT|>.", "It'S I'LL", "#", "a.b,c...d !!", "ab.,!"
    ]


def expected(some: list[str | None]) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(PATH)
    found = tokenizer.encode_batch([t or "" for t in some], add_special_tokens=False)
    return [[*e.ids, END] for e in found]


def written(spark, rows, **sizes):
    folder = staging_folder(spark)
    docs = spark.createDataFrame(rows, "id long, body string").selectExpr("*", "'x' AS key", "1 AS hash")
    fields = Fields("id", "body")
    tokenfiles.write_shards(docs.repartition(3), f"{folder}/shards", CONTENT, END, fields, **sizes)
    tokenfiles.write_index(tokenfiles.documents(spark, f"{folder}/shards"), f"{folder}/index")
    return f"{folder}/shards", f"{folder}/index"


def test_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr(tokenfiles, "MAX_WORDS", 500)  # the memory starts anew often
    encoder = tokenfiles.WordEncoder(CONTENT, END)
    some = texts(1500)
    for start in range(0, len(some), 50):
        part = some[start : start + 50]
        ids, counts = encoder.encode(part)
        cut = np.split(ids, np.cumsum(counts)[:-1])
        assert [c.tolist() for c in cut] == expected(part)


def test_files_hold_all_ids_in_order(spark):
    rows = [(i * 7 - 300, t) for i, t in enumerate(texts(300, seed=2))] + [(10**15, None), (-(10**15), "")]
    path, index = written(spark, rows, shard_bytes=2000)
    keys, ids = zip(*sorted((k, i) for (k, _), i in zip(rows, expected([t for _, t in rows]))))
    shards = sorted(
        (tokenfiles.parse_shard(r["content"]) for r in tokenfiles.shard_files(spark, path).collect()),
        key=lambda s: s.number,
    )
    assert len(shards) > 1
    assert np.concatenate([s.ids for s in shards]).tolist() == [i for own in ids for i in own]
    assert np.concatenate([s.keys for s in shards]).tolist() == list(keys)
    starts = {r["shard"]: r["before"] for r in tokenfiles.shard_starts(tokenfiles.documents(spark, path)).collect()}
    found = {r["key"]: r for r in tokenfiles.documents(spark, path).collect()}
    at = 0
    for key, own in zip(keys, ids):
        row = found[key]
        assert starts[row["shard"]] + row["first"] == at and row["n_ids"] == len(own)
        assert row["ids_crc32"] == crc32(np.array(own, "<u4").tobytes())
        at += len(own)


def test_lookup_and_fetch(spark):
    rows = [(i * 3, t) for i, t in enumerate(texts(200, seed=4))]
    path, index = written(spark, rows)
    asked = spark.createDataFrame([(3,), (3,), (9,), (4,), (None,), (-1,)], "doc_id long")
    got = sorted((r["key"], r["ids"]) for r in tokenfiles.fetch(asked, path, index).collect())
    by_key = dict(zip([k for k, _ in rows], expected([t for _, t in rows])))
    assert got == [(3, by_key[3]), (9, by_key[9])]
    places = tokenfiles.look_up(asked, spark.read.parquet(index)).collect()
    assert sorted(p["key"] for p in places) == [3, 3, 9]


def test_nulls_repeats_and_long_texts(spark):
    rows = [(None, "no key"), (None, None), (5, "first"), (5, "second"), (6, "word " * 100_000)]
    path, index = written(spark, rows)
    found = tokenfiles.documents(spark, path).collect()
    assert len(found) == len(rows) and sum(r["key"] is None for r in found) == 2
    keys = spark.createDataFrame([(5,), (6,)], "doc_id long")
    places = {r["key"]: r for r in tokenfiles.look_up(keys, spark.read.parquet(index)).collect()}
    assert places[6]["n_ids"] == 100_001
    fives = sorted((r["shard"], r["first"]) for r in found if r["key"] == 5)
    assert (places[5]["shard"], places[5]["first"]) == fives[0]


def test_empty_table(spark):
    path, index = written(spark, [])
    assert tokenfiles.documents(spark, path).count() == 0
    keys = spark.createDataFrame([(1,)], "doc_id long")
    assert tokenfiles.look_up(keys, spark.read.parquet(index)).count() == 0


def test_key_must_be_whole(spark):
    docs = spark.createDataFrame([("a", "b")], "doc_id string, text string")
    with pytest.raises(ValueError):
        tokenfiles.write_shards(docs, staging_folder(spark), CONTENT, END)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**63), 2**63, n, dtype=np.int64))
    function = tokenfiles.PerfectHash.build(keys)
    again = tokenfiles.PerfectHash(function.sizes, function.packed())
    assert sorted(again.slots(keys).tolist()) == list(range(len(keys)))
    strangers = np.arange(50, dtype=np.int64)
    assert len(again.slots(strangers)) == 50


def test_query_has_a_row_for_every_document(spark):
    from shopledger.llm.queries import QUERIES

    folder = staging_folder(spark)
    rows = [(None, "no key"), (None, None), (7, "the first"), (7, "another one"), (7, "and a third text"), (8, "x")]
    rows += [(9, f"hot {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op2_token_files"](spark, folder).collect()
    ids = expected([text for _, text in rows])
    sums = [crc32(np.array(own, "<u4").tobytes()) for own in ids]
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in found) == sorted(
        (key or 0, len(own), crc) for (key, _), own, crc in zip(rows, ids, sums)
    )
    spans = sorted((r["start"], r["start"] + r["n_tokens"]) for r in found)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_a_third_of_equal_rows_goes_to_several_tasks(spark, conf, tmp_path):
    conf(shuffle__partitions="8", adaptive__coalescePartitions__enabled="false")
    docs = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 7, id) as doc_id", "if(id % 3 = 0, 'the same text', string(id)) as text"
    )
    tokenfiles.write_shards(docs.repartition(5), f"{tmp_path}/shards", CONTENT, END)
    found = tokenfiles.documents(spark, f"{tmp_path}/shards")
    sizes = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 1500
    starts = {r["shard"]: r["before"] for r in tokenfiles.shard_starts(found).collect()}
    rows = sorted((starts[r.shard] + r.first, r.n_ids, r.key) for r in found.collect())
    assert [r[0] for r in rows[1:]] == [a + n for a, n, _ in rows][:-1]
    assert [r[2] for r in rows] == sorted(r[2] for r in rows)
