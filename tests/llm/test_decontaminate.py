from __future__ import annotations

import random

import pytest

from shopledger.llm import decontaminate as dec
from shopledger.llm.batches import Fields


def distances(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to a run of ``text``, and the first end with it."""
    row = list(range(len(item) + 1))
    ends = [row[-1]]
    for symbol in text:
        last, row = row, [0]
        for i, own in enumerate(item, 1):
            row.append(min(last[i] + 1, row[-1] + 1, last[i - 1] + (own != symbol)))
        ends.append(row[-1])
    return min(ends), ends.index(min(ends))


def corpus(seed: int = 0):
    """Items, and documents with edited copies of them; (documents, items, planted)."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(10, 60)))) for i in range(40)]
    docs, planted = [], set()
    for key in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 200))
        if key % 2:
            item, text = items[key % len(items)]
            copy = text.split()
            for _ in range(rng.randint(0, dec.max_distance(len(copy), dec.Settings()))):
                at, kind = rng.randrange(len(copy)), rng.random()
                if kind < 0.4:
                    copy[at] = rng.choice(vocabulary)
                elif kind < 0.7:
                    del copy[at]
                else:
                    copy.insert(at, rng.choice(vocabulary))
            at = rng.randint(0, len(words))
            words[at:at] = copy
            planted.add((key, item))
        docs.append((key, ", ".join(words).upper() if key % 5 == 0 else " ".join(words)))
    return docs, items, planted


def brute_force(docs, items, settings=dec.Settings()):
    found = {}
    for key, text in docs:
        for item, own in items:
            pattern = dec.words_of(own)
            if len(pattern) >= settings.min_words:
                least, end = distances(pattern, dec.words_of(text or ""))
                if least <= dec.max_distance(len(pattern), settings):
                    found[key, item] = least
    return found


def test_edit_match_by_definition():
    rng = random.Random(1)
    for _ in range(3000):
        item = [rng.randint(0, 3) for _ in range(rng.randint(1, 9))]
        text = [rng.randint(0, 4) for _ in range(rng.randint(0, 14))]
        assert dec.edit_match(item, text, 99) == distances(item, text)
        least, _ = distances(item, text)
        assert (dec.edit_match(item, text, least - 1) is None) or least == 0


def test_finds_what_brute_force_finds(spark):
    docs, items, planted = corpus()
    expected = brute_force(docs, items)
    assert planted <= set(expected)
    found = dec.find(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    got = {(r["key"], r["item"]): r for r in found}
    assert len(got) == len(found)
    assert set(got) <= set(expected)
    assert len(got) >= 0.99 * len(expected)
    texts, sources = dict(docs), dict(items)
    for pair, row in got.items():
        assert row["distance"] == expected[pair]
        run = dec.words_of(texts[pair[0]])[row["first_word"] : row["end_word"]]
        assert distances(dec.words_of(sources[pair[1]]), run)[0] <= row["distance"]


def test_filters_lose_nothing():
    docs, items, planted = corpus(seed=3)
    search = dec.Walks(items, dec.Settings())
    where = dict(docs)
    for key, item in planted:
        words = [search.vocabulary.get(w, search.strange) for w in dec.words_of(where[key])]
        text, _ = search._laid([words])
        assert any(mask.any() for mask in search._windows(text))


@pytest.mark.parametrize("length", [5, 6, 9, 10, 15, 40, 200])
def test_exact_copies_of_any_length(length):
    rng = random.Random(length)
    item = " ".join(f"x{rng.randint(0, 50)}" for _ in range(length))
    search = dec.Walks([(1, item)], dec.Settings())
    found = list(search.matches(["before " * 30 + item + " after" * 30, item, "nothing of it " * 90]))
    assert [(which, distance) for which, _, distance, _, _ in found] == [(0, 0), (1, 0)]
    assert found[0][3:] == (30, 30 + length)


def test_blocks_of_items_give_the_same(spark):
    docs, items, _ = corpus(seed=5)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    small = dec.Settings(block_bytes=2000)
    assert len(list(dec.item_blocks(benchmark, small))) > 2
    pairs = [
        {(r["key"], r["item"], r["distance"]) for r in dec.find(table, benchmark, settings=s).collect()}
        for s in (dec.Settings(), small)
    ]
    assert pairs[0] == pairs[1]
    clean = {r["doc_id"] for r in dec.keep_clean(table, benchmark, settings=small).collect()}
    assert clean == {key for key, _ in docs} - {key for key, _, _ in pairs[0]}


def test_edge_cases(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (None, f"say {item} now"), (3, "word " * 100_000 + item), (4, item)]
    rows += [(4, item), (5, item.replace("five", "changed").upper()), (6, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "'a' AS item", "*", "1 AS key", "2 AS distance"
    )
    benchmark = spark.createDataFrame(
        [(7, item), (7, item), (8, None), (None, item), (9, "too few words")],
        "item_id long, text string",
    )
    found = dec.find(docs, benchmark).collect()
    assert sorted((r["key"] or 0, r["item"], r["distance"]) for r in found) == [
        (0, 7, 0), (3, 7, 0), (4, 7, 0), (4, 7, 0), (5, 7, 1),
    ]
    clean = dec.keep_clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 6]
    assert dec.find(docs.limit(0), benchmark).count() == 0
    assert dec.find(docs, benchmark.limit(0)).count() == 0
    assert dec.keep_clean(docs, benchmark.limit(0)).count() == len(rows)


def test_recall_at_the_edit_limit_for_each_length_of_a_mixed_benchmark():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    lengths = [20] * 190 + [150] * 8 + [300] * 2
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate(lengths)]
    search = dec.Walks(items, dec.Settings())
    for own, length in ((range(190), 20), (range(190, 198), 150), (range(198, 200), 300)):
        texts, planted = [], []
        for trial in range(100):
            item = own[trial % len(own)]
            copy = items[item][1].split()
            for _ in range(dec.max_distance(length, dec.Settings())):
                at, kind = rng.randrange(len(copy)), rng.randrange(3)
                if kind == 0:
                    copy[at] = "strange"
                elif kind == 1:
                    del copy[at]
                else:
                    copy.insert(at, "strange")
            texts.append(" ".join([*rng.choices(vocabulary, k=30), *copy, *rng.choices(vocabulary, k=30)]))
            planted.append((trial, item))
        found = {(which, item) for which, item, *_ in search.matches(texts)}
        assert len(found & set(planted)) >= 96, length


def test_short_items_and_scripts_without_spaces():
    chinese = "今天天气很好我们一起去公园散步吧"
    items = [(1, "Four short words here"), (2, "吃饭了吗"), (3, chinese), (4, "four short words, HERE"), (5, "..."), (6, "สวัสดีครับ")]
    search = dec.Walks(items, dec.Settings())
    texts = [
        "now four short words here. Four short words here", "four short words where",
        "他问：吃饭了吗？", f"有人说{chinese.replace('很', '真')}。然后", "吃了饭吗", "และสวัสดีครับผม",
    ]
    found = [(which, search.keys[item], *rest) for which, item, *rest in search.matches(texts)]
    assert sorted(found) == [
        (0, 1, 0, 1, 5), (0, 4, 0, 1, 5), (2, 2, 0, 2, 6), (3, 3, 1, 3, 19), (5, 6, 0, 3, 3 + len(dec.words_of(items[5][1]))),
    ]
    only_short = dec.Walks(items[:2], dec.Settings())
    assert [row[:2] for row in only_short.matches(texts)] == [(0, 0), (2, 1)]
    assert dec.words_of("Ab_1 c-d 中a文") == ["ab_1", "c", "d", "中", "a", "文"]


def test_blocks_are_searched_one_at_a_time(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=20))) for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=30)), 1, "x", i) for i in range(40)]
    rows += [(100 + i, f"start {items[i][1]} end", 2, "y", i) for i in range(0, 60, 7)]
    rows += [rows[0], (None, None, None, None, None), (7, items[59][1], 0, "z", 0)]
    docs = spark.createDataFrame(rows, "key long, `my col` string, `a-b` int, `row` string, number long")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    settings = dec.Settings(block_bytes=1200)
    assert len(list(dec.item_blocks(benchmark, settings))) >= 4
    found = dec.keep_clean(
        docs, benchmark, Fields("key", "my col"), settings=settings, folder=str(tmp_path)
    )
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.columns == docs.columns
    kept = [row for row in rows if row[1] is None or not any(text in row[1] for _, text in items)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(kept, key=repr)
