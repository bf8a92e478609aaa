from __future__ import annotations

import random

import pytest

from shopledger.llm import langid
from shopledger.llm.batches import Fields

SYLLABLES = {
    "aa": "the and ing ion ent her tha nth".split(),
    "bb": "sch ein ich und der cht ung gen".split(),
    "cc": "que eau les ais ont ent ail our".split(),
}


def sentence(lang: str, rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words))


def labelled(n: int, seed: int = 0) -> list[tuple[int, str, str]]:
    rng = random.Random(seed)
    langs = rng.choices(sorted(SYLLABLES), weights=[8, 1, 1], k=n)
    return [(i, sentence(lang, rng, rng.randint(5, 120)), lang) for i, lang in enumerate(langs)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    model = langid.fit(frame(spark, labelled(300)))
    assert sorted(model) == sorted(SYLLABLES)
    test = labelled(300, seed=9)
    found = {r["key"]: r for r in langid.predict(frame(spark, test), model).collect()}
    right = sum(found[i]["lang_pred"] == lang for i, _, lang in test)
    assert right >= 0.99 * len(test)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_whole_text_decides(spark):
    rng = random.Random(4)
    text = sentence("aa", rng, 30) + " " + sentence("bb", rng, 5000)
    model = langid.fit(frame(spark, labelled(300)))
    assert langid.Classifier(model, langid.Settings())(text)[0] == "bb"


def test_edge_cases(spark):
    model = langid.fit(frame(spark, labelled(200)))
    rows = [(1, None, None), (2, "", "aa"), (3, "123 !?", "aa"), (None, "the ing", "aa"), (4, "q", None)]
    rows += [(5, "the and ing " * 50_000, "aa")] + [(6, sentence("cc", random.Random(3), 30), "cc")] * 2
    docs = frame(spark, rows).selectExpr("*", "1 AS key", "'x' AS lang_pred", "'y' AS score")
    found = langid.predict(docs, model)
    assert found.columns == ["key", "lang_pred", "score", "margin", "accepted"]
    by_key = {r["key"]: r for r in found.collect()}
    assert found.count() == len(rows)
    for key in (1, 2, 3):
        assert (by_key[key]["lang_pred"], by_key[key]["accepted"]) == (langid.UNDETERMINED, False)
    assert by_key[5]["lang_pred"] == "aa" and by_key[6]["lang_pred"] == "cc"
    kept = langid.keep_accepted(docs, model)
    assert kept.columns == docs.columns
    expected = [r["key"] for r in found.filter("accepted").collect()]
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(k or -1 for k in expected)


def test_narrow_margin_is_rejected(spark):
    rng = random.Random(2)
    model = langid.fit(frame(spark, labelled(300)))
    strict = langid.Settings(min_margin=0.9)
    text = sentence("aa", rng, 40)
    docs = frame(spark, [(1, text, None)])
    assert langid.predict(docs, model).first()["accepted"]
    assert not langid.predict(docs, model, settings=strict).first()["accepted"]


def test_no_labels(spark):
    empty = frame(spark, [])
    assert langid.fit(empty) == {}
    assert langid.predict(empty, {}).count() == 0
    assert langid.predict(frame(spark, [(1, "text", None)]), {}).first()["lang_pred"] == "und"


def test_one_language_and_too_many(spark):
    model = langid.fit(frame(spark, [(1, "the and", "aa")]))
    assert langid.predict(frame(spark, [(1, "words", None)]), model).first()["score"] == 1.0
    with pytest.raises(ValueError):
        langid.fit(frame(spark, labelled(50)), settings=langid.Settings(max_languages=2))


def test_sample_does_not_depend_on_order_or_copies(spark):
    rows = labelled(200)
    small = langid.Settings(sample_texts=16)
    one = langid.fit(frame(spark, rows), settings=small)
    other = langid.fit(frame(spark, rows[::-1] + rows[:50]).repartition(7), settings=small)
    assert one == other
    named = frame(spark, rows).withColumnsRenamed({"doc_id": "id", "text": "body"})
    assert langid.fit(named, Fields("id", "body"), settings=small) == one


def test_predictions_equal_plain_compression(spark):
    import zstandard

    settings = langid.Settings(block_bytes=64)
    dictionaries = langid.fit(frame(spark, labelled(60)), settings=settings)
    rows = labelled(60, seed=5) + [(900, "the sch ein", None), (901, "q" * 700, None), (902, None, None)]
    found = langid.predict(frame(spark, rows), dictionaries, settings=settings)
    by_key = {r["key"]: r for r in found.collect()}
    for key, text, _ in rows:
        clean = langid.normalised(text or "")
        sizes = {}
        for label in sorted(dictionaries):
            content = zstandard.ZstdCompressionDict(
                dictionaries[label], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            total = 0
            for start in range(0, len(clean), 64):
                plain = zstandard.ZstdCompressor(
                    level=settings.level, dict_data=content, write_content_size=False,
                    write_checksum=False, write_dict_id=False,
                )
                total += len(plain.compress(clean[start : start + 64]))
            sizes[label] = total - 4
        row = by_key[key]
        if not clean:
            assert (row["lang_pred"], row["score"]) == (langid.UNDETERMINED, 0)
            continue
        best = min(sizes, key=lambda label: (sizes[label], label))
        second = min(size for label, size in sizes.items() if label != best)
        margin = (second - sizes[best]) / max(1, second)
        assert row["lang_pred"] == best
        assert row["margin"] == pytest.approx(margin) and row["score"] == pytest.approx(margin / (margin + 0.05))


def test_rows_without_a_key_are_predicted_and_not_learned_from(spark, tmp_path):
    from shopledger.llm.queries import QUERIES

    rows = labelled(200) + [(None, "the and ing ion", "zz")] * 50
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op1_language_id"](spark, str(tmp_path))
    assert found.count() == len(rows)
    own = found.filter("doc_id is null").select("held_out", "lang_pred").distinct().collect()
    assert [tuple(r) for r in own] == [(False, "aa")]
    assert found.filter("held_out is null").count() == 0
