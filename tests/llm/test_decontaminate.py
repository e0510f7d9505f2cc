"""Benchmark decontamination: edit search against plain dynamic programming, recall on edited passages, edge rows."""

import random

import numpy as np

from reelstat.llm import decontaminate as D
from reelstat.llm.common import hashes


def plain_best(item, region):
    """Least edit distance of the item to any part of the region."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(region, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_best_match_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(200):
        item = np.array([rng.randint(1, 5) for _ in range(rng.randint(1, 9))], np.uint64)
        region = np.array([rng.randint(1, 5) for _ in range(rng.randint(0, 14))], np.uint64)
        edits, start, end = D.best_match(item, region)
        assert edits == plain_best(item.tolist(), region.tolist())
        assert 0 <= start <= end <= len(region)
        assert plain_best(item.tolist(), region[start:end].tolist()) == edits


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.choice("sid")
        if kind == "s":
            words[at] = f"new{rng.randint(0, 999)}"
        elif kind == "i":
            words.insert(at, f"new{rng.randint(0, 999)}")
        else:
            del words[at]
    return words


def test_recall_of_edited_passages(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(12, 50)))) for i in range(60)]
    docs, wanted = [], set()
    for d in range(240):
        words = rng.choices(vocabulary, k=rng.randint(0, 200))
        if d % 2:
            i, passage = items[d % 60]
            passage = passage.split()
            passage = _edited(rng, passage, rng.randint(0, len(passage) // 5))
            at = rng.randint(0, len(words))
            words[at:at] = passage
            if plain_best(items[d % 60][1].split(), words) <= D.allowed_edits(len(items[d % 60][1].split()), 0.2):
                wanted.add((d, i))
        docs.append((d, "  ".join(words).upper() if d % 3 else ", ".join(words)))
    docs += [(1000, None), (1001, ""), (1002, " \n"), (None, items[0][1]), (7, items[3][1]), (7, items[3][1])]
    frame = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, item_id string, edits int")
    bench = spark.createDataFrame(items + [(900, None), (901, ""), (902, "the")], "item_id long, text string")
    rows = D.find_leaks(frame, bench).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    exact = {(d, i) for d, t in docs if t and d is not None for i, item in items
             if plain_best(item.split(), [w.decode() for w in D.plain_words(t)]) <= D.allowed_edits(len(item.split()), 0.2)}
    assert len(found & wanted) >= 0.95 * len(wanted)
    assert {f for f in found if f[0] is not None} <= exact
    assert (None, 0) in found and sum(r.doc_id == 7 and r.item_id == 3 for r in rows) == 2


def test_long_passages_with_all_allowed_edits_are_found(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=length))) for i, length in enumerate([60, 90, 120, 200, 300, 400])]
    docs = []
    for d in range(60):
        passage = items[d % 6][1].split()
        words = rng.choices(vocabulary, k=rng.randint(0, 300))
        at = rng.randint(0, len(words))
        words[at:at] = _edited(rng, passage, D.allowed_edits(len(passage), 0.2))
        docs.append((d, " ".join(words)))
    docs.append((60, " ".join([items[0][1], " ".join(_edited(rng, items[0][1].split(), 12)), items[0][1]])))
    rows = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.doc_id < 60} == {(d, d % 6) for d in range(60)}
    for r in rows:
        words, item = docs[r.doc_id][1].split(), items[r.item_id][1].split()
        assert plain_best(item, words[r.start_word:r.end_word]) == r.edits <= D.allowed_edits(len(item), 0.2)
        if r.doc_id < 60:
            assert r.edits == plain_best(item, words)
    assert len([r for r in rows if r.doc_id == 60]) == 3


def test_blocks_share_the_edits():
    for n in range(5, 500):
        blocks = D.blocks_of(n, D.allowed_edits(n, 0.2))
        assert sum(length for _, length, _ in blocks) == n and (n < 8 or all(8 <= length <= 15 for _, length, _ in blocks))
        assert sum(e + 1 for _, _, e in blocks) > D.allowed_edits(n, 0.2)  # not all blocks can have more


def test_walks_reach_the_recall_at_every_length_and_full_error():
    """A block (of the blocks that may be the one with few edits) shares a key with some window of the edited passage."""
    rng = random.Random(11)
    for n in (8, 9, 10, 11, 13, 15, 16, 20, 23, 31, 60, 120, 200, 400):
        caught = 0
        trials = 100 if n < 100 else 40
        for _ in range(trials):
            item = [rng.getrandbits(64) for _ in range(n)]
            text = [rng.getrandbits(64) for _ in range(5)] + _edited(rng, item, D.allowed_edits(n, 0.2)) + [rng.getrandbits(64) for _ in range(20)]
            text = np.array([hash(x) & (2 ** 64 - 1) if isinstance(x, str) else x for x in text], np.uint64)
            item = np.array(item, np.uint64)
            for a, length, _ in D.blocks_of(n, D.allowed_edits(n, 0.2)):
                windows = np.lib.stride_tricks.sliding_window_view(text, length)
                if np.isin(D._keys(windows), D._keys(item[None, a:a + length])).any():
                    caught += 1
                    break
        assert caught >= (0.97 if n < 16 else 0.99) * trials, (n, caught, trials)


def test_short_items_and_texts_without_word_breaks(spark):
    items = [(1, "only five words are here"), (2, "a b c d"), (3, "汉字没有空格也要找到它们才行"), (4, "six words which must match whole")]
    docs = [(1, "so, Only five words are here."), (2, "only five word are here"), (3, "前言汉字没有空格也要找到它们才行后语"), (4, "a b c d"), (5, "x six words which must match whole y")]
    rows = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in rows) == [(1, 1, 0), (3, 3, 0), (5, 4, 0)]


def test_windows_without_a_key_in_common_give_nothing(spark):
    item = [f"w{i}" for i in range(15)]
    text = " ".join(item[0:3] + ["x"] + item[3:6] + ["y"] + item[6:9] + ["z"] + item[9:12])
    windows = D._Windows(D._place(D._triples(hashes([w.encode() for w in item]))), np.empty(0, np.int64), [15 * 256 + 3])
    symbols = hashes(D.plain_words(text))
    assert list(windows.hits(symbols, np.array([len(symbols)]))) == []
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    none = spark.createDataFrame([(1, " ".join(f"{w} q" for w in item)), (2, " ".join(item[:5] * 4))], "doc_id long, text string")
    assert D.find_leaks(none, bench).collect() == []


def test_many_items_in_many_partitions(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"v{rng.randint(0, 50)}" for _ in range(20))) for i in range(40)]
    docs = spark.createDataFrame([(i, f"start {t} stop") for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, D.find_leaks(docs, bench.coalesce(1)).collect()))
    assert sorted(map(tuple, D.find_leaks(docs.repartition(5), bench.repartition(7)).collect())) == whole
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in whole if r[0] == r[1]] == [(i, i, 1, 21, 0) for i in range(40)]


def test_a_passage_in_a_very_long_text_and_a_text_of_passages(spark):
    item = " ".join(f"w{i}" for i in range(30))
    long = "x y z " * 200_000 + item + " x y z" * 100_000
    rows = D.find_leaks(spark.createDataFrame([(1, long), (2, " ".join([item] * 50))], "doc_id long, text string"),
                        spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.start_word, r.edits) for r in rows if r.doc_id == 1] == [(600_000, 0)]
    assert sorted(r.start_word for r in rows if r.doc_id == 2) == list(range(0, 1500, 30))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, extra string")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert D.find_leaks(none, bench).count() == 0
    assert D.find_leaks(bench.withColumnRenamed("item_id", "doc_id"), bench.limit(0)).count() == 0
    assert D.without_leaks(none, bench).columns == ["doc_id", "text", "extra"]


def test_searcher_needs_no_shared_random_state():
    window = np.stack([hashes([b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h"])])
    assert (D.cgk_keys(window, 5) == D.cgk_keys(window, 5)).all()
