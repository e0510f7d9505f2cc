"""Collocations against plain counting of every phrase."""

import collections
import pathlib
import random
import re
import time

import numpy as np
import pytest

from reelstat.llm import collocations, wordhash

SCHEMA = "doc_id long, text string, lang string, phrase string, c int, n int, shard int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, 3) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(partitions)


def brute_counts(rows):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return counts, totals


def brute(rows, least, most):
    counts, totals = brute_counts(rows)
    candidates = {p: c for p, c in counts.items() if c >= least and len(p[1]) > 1}
    out = []
    for (lang, words), a in candidates.items():
        if any(la == lang and len(q) > len(words) and any(q[i:i + len(words)] == words for i in range(len(q))) and 100 * b >= 80 * a for (la, q), b in candidates.items()):
            continue
        score, _, left, right = min((2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]])
                                    for k in range(1, len(words)))
        out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    rows, rank = [], collections.Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= most:
            rows.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return rows


def random_rows(seed, n=150):
    """Few words, phrases that recur, and words that turn up in the last texts only."""
    rng = random.Random(seed)
    fixed = ["new york city hall", "New  York", "as soon\tas", "ÉTÉ été É"]
    rows = []
    for i in range(n):
        words = [rng.choice([*fixed, *[f"w{rng.randint(0, 12)}{rng.choice(['', '', ',', '.', chr(10)])}" for _ in range(6)]]) for _ in range(rng.choice([0, 1, 5, 40]))]
        words += ["late phrase here again"] * (i > n * 0.7)
        rows.append((" ".join(words), rng.choice(["en", "en", "fr", None, "und"])))
    return [*rows, (None, "en"), ("", None), (" \t\n", "de"), rows[3], rows[3]]


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("seed", "least", "most"), [(1, 4, 2000), (2, 9, 7)])
def test_equals_plain_counting(spark, seed, least, most):
    rows = random_rows(seed)
    expected = brute(rows, least, most)
    assert len(expected) > 15
    assert found(collocations.top_collocations(frame(spark, rows), most, least)) == sorted(expected)


def test_a_small_map_and_other_shards_change_no_count(spark):
    rows = random_rows(3)
    counts, totals = brute_counts(rows)
    expected = sorted([(la, len(p), " ".join(p), c) for (la, p), c in counts.items() if c >= 5] + [(la, 0, "", n) for la, n in totals.items() if n])
    for shards, slots in ((1, 1 << 16), (3, 1 << 16), (2, 4)):
        got = collocations.frequent_phrases(frame(spark, rows), least=5, shards=shards, slots=slots)
        assert sorted(tuple(r) for r in got.collect()) == expected


def run_of(*texts, lang="en"):
    run = collocations._Run(lang, texts=True)
    for t in texts:
        run.add([t])
    return run


def test_phrases_join_when_both_subphrases_have_been_seen():
    """The map decides what a scan counts: nothing longer than a word at first, then for one cycle."""
    run = run_of("a b A", " b")  # two texts are two pieces
    run2 = run_of("a b a b")
    reached = np.full(1 << 16, 255, np.uint8)
    first = {k: sorted(c.tolist()) for k, _, _, c in collocations.phrase_counts(run2, reached, 0, 2)}
    assert first == {0: [4], 1: [2, 2]} == {k: sorted(c.tolist()) for k, _, _, c in collocations.phrase_counts(run, reached, 0, 2)}
    words = dict(zip("ab", next(s for k, s, *_ in collocations.phrase_counts(run2, reached, 0, 2) if k == 1).T, strict=True))
    slot = {w: collocations.slots_of(h[:1], 1 << 16)[0] for w, h in words.items()}
    reached[slot["a"]] = 1
    assert [k for k, *_ in collocations.phrase_counts(run2, reached, 1, 2)] == [0, 1]
    reached[slot["b"]] = 2
    second = {k: (since.tolist(), c.tolist()) for k, _, since, c in collocations.phrase_counts(run2, reached, 2, 2)}
    assert second == {2: ([2, 2], [2, 1])}
    assert [k for k, *_ in collocations.phrase_counts(run2, reached, 4, 2)] == []


def test_hashes_follow_the_words_alone(monkeypatch):
    monkeypatch.setattr(wordhash, "_PART", 16)
    rng = random.Random(4)
    words = ["w%d" % i for i in range(9)] + ["É" * 30, "long" * 40, "x"]
    text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n"]) for _ in range(400))
    found, piece, starts, ends = wordhash.word_hashes(text.encode(), collocations._KINDS)
    data = text.encode()
    by_word = collections.defaultdict(set)
    for i in range(len(starts)):
        by_word[data[starts[i]:ends[i]]].add(tuple(found[:, i]))
    assert {w.decode() for w in by_word} == set(words) and all(len(h) == 1 for h in by_word.values())
    assert len(set().union(*by_word.values())) == len(words)
    assert piece.tolist() == sorted(piece) and (wordhash.word_hashes(b"ABC")[0] == wordhash.word_hashes(b"abc")[0]).all()
    assert wordhash.word_hashes(b"")[0].shape == (2, 0)


def test_runs_gather_texts_of_one_language():
    run = run_of("One two. Three", "four")
    assert run.size == 4 and run.text(0, 2) == "one two" and run.text(3, 1) == "four"
    same = {k: w.tolist() for k, _, w in run.phrases()}
    assert same[2] == [True, False, False]
    half = np.zeros((2, 3), np.uint64)
    half[1] = [5, 6, 5]  # equal in one half only
    first, counts = collocations._grouped(half)
    assert sorted(zip(half[1][first].tolist(), counts.tolist())) == [(5, 2), (6, 1)]


def test_empty_table_and_exact_scores(spark):
    assert collocations.top_collocations(frame(spark, [("a b", "en")]).where("false")).collect() == []
    assert collocations.top_collocations(frame(spark, [("a b", "en")] * 29)).collect() == []
    big = spark.createDataFrame([("en", 1, "a", 9 * 10 ** 17), ("en", 1, "b", 8 * 10 ** 17 + 1), ("en", 2, "a b", 7 * 10 ** 17 + 3), ("en", 0, "", 10 ** 18)],
                                "lang string, length int, phrase string, c long")
    row = collocations.scored(big).first()
    assert row["score"] == 2_000_000 * (7 * 10 ** 17 + 3) // (17 * 10 ** 17 + 1)


def test_counted_phrases_take_little_disk(spark):
    """What is shuffled and written of a phrase: 96 bits of its hash, and columns that compress well."""
    reached = spark.sparkContext.broadcast(np.full(1 << 8, 255, np.uint8))
    rows = collocations._scanned(frame(spark, [(" ".join(f"w{i}" for i in range(n, n + 20_000)), "en") for n in (0, 20_000)], 1), reached, 0, 4)
    kept, path = collocations._kept(spark, rows)
    assert kept.where("length = 1").distinct().count() == 40_000
    assert sum(f.stat().st_size for f in pathlib.Path(path).glob("*.parquet")) < 14 * 40_000


def test_shuffles_of_a_scan_are_removed_with_it(spark):
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in folders for f in pathlib.Path(d).rglob("shuffle_*.data")}

    setting, before = spark.conf.get(collocations._CLEANUP), files()
    kept, _ = collocations._kept(spark, spark.range(70).selectExpr("id % 7 AS a").groupBy("a").count())
    for _ in range(100):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert sorted(tuple(r) for r in kept.collect()) == [(a, 10) for a in range(7)]
    assert spark.conf.get(collocations._CLEANUP) == setting
