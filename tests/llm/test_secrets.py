"""Secret scans against a plain reading of the patterns, and hostile texts in bounded time."""

import hashlib
import random
import re
import string
import time

import pytest

from reelstat.llm import secrets, url_filter

WORD = string.ascii_letters + string.digits


def plain_assign(text):
    """Leftmost non-overlapping matches of the assign pattern, read character by character from its definition."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    out, at = [], 0
    while at < len(text):
        end = None
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if not low.startswith(name, at):
                continue
            i = at + len(name)
            i += text[i:i + 1] in ("'", '"') and text[i:i + 1] != ""
            while text[i:i + 1] == " ":
                i += 1
            if text[i:i + 1] not in (":", "=") or not text[i:i + 1]:
                continue
            i += 1
            while text[i:i + 1] == " ":
                i += 1
            i += text[i:i + 1] in ("'", '"') and text[i:i + 1] != ""
            start = i
            while i < len(text) and text[i] in WORD + "+/_.=-":
                i += 1
            if i > start:
                end = i
                break
        if end is None:
            at += 1
        else:
            if end - start >= 8:
                out.append((at, end))
            at = end
    return out


def plain_runs(text, first, alphabet, least):
    out, at = [], 0
    while at < len(text):
        i = at + len(first)
        if text.startswith(first, at):
            while i < len(text) and text[i] in alphabet:
                i += 1
            if i > at + len(first):
                if i - at >= least:
                    out.append((at, i))
                at = i
                continue
        at += 1
    return out


def plain_base(text):
    spans = [("assign", *s) for s in plain_assign(text)]
    spans += [("access", *s) for s in plain_runs(text, "AKIA", string.ascii_uppercase + string.digits, 16)]
    spans += [("hex", *s) for s in plain_runs(text, "", "0123456789abcdef", 32)]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def fixture_texts():
    rng = random.Random(8)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "APIkey", "apikey", "'", '"', " ", "  ", ":", "=", "\t", "AKIA", "AKIAAKIA", "é", "K", "ſ"]
    out = [None, "", "password=", "token = 'abcdefgh'", "secret:abcdefg", "tokentoken=12345678"]
    for _ in range(400):
        pieces = [rng.choice(parts) if rng.random() < 0.75 else "".join(rng.choices(rng.choice([WORD, "0123456789abcdef", string.ascii_uppercase + string.digits, "+/_.=-ab"]),
                                                                                     k=rng.choice([1, 7, 8, 16, 31, 32, 40]))) for _ in range(rng.randint(1, 9))]
        out.append("".join(pieces))
    return [*out, out[7], out[7]]


def test_base_spans_and_digests_equal_a_plain_reading(spark):
    texts = fixture_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.scan(docs).select("doc_id", *[c.alias(n) for n, c in secrets.digest_columns().items()]).collect()
    assert len(found) == len(texts)
    hits = 0
    for r in found:
        want = plain_base(texts[r["doc_id"]] or "")
        hits += len(want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == kind for k, _, _ in want) for kind in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        spans = [s for s in r["spans"].split(",") if s]
        assert [s for s in spans if not s.startswith("random")] == [f"{k}:{a}:{b}" for k, a, b in want]
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
    assert hits > 50


def test_random_strings_are_found_and_known_forms_are_not():
    rng = random.Random(1)
    for size, least in ((16, 190), (18, 195), (24, 198)):
        for setting in ("{}", "key={} x", "https://example.com/path/{}"):
            found = sum(any(k == "random" for k, _, _ in secrets.find_spans(setting.format("".join(rng.choices(WORD, k=size))))) for _ in range(200))
            assert found >= least, (size, setting)
    clean = ["internationalization_of_the_configuration", "https://example.com/path/to/some/article-about-things", "550e8400-e29b-41d4-a716-446655440000",
             "A" * 40, "Donaudampfschifffahrt", "some_function_name_123"]
    assert [secrets.find_spans(t) for t in clean] == [[] for _ in clean]


@pytest.mark.parametrize("text", ["a" + "=" * 80_000 + "9a", "ab=" * 40_000, "a1" * 60_000, "token " * 30_000, "token" + " " * 100_000, "a9_" * 50_000, "AKIA" * 40_000,
                                  ("0a" * 16 + " ") * 8_000 + "Xy1" * 9])
def test_hostile_texts_take_bounded_time(text):
    secrets.find_spans("warm up aaaaaaaaaaaaaaaaaaaaaaaaaa9")
    began = time.process_time()
    secrets.find_spans(text)
    assert time.process_time() - began < 5


def test_clashing_names_empty_table_and_long_text(spark):
    docs = spark.createDataFrame([(1, "password=abcdefgh1 x", "mine", 5), (2, "x " * 1_000_000, "m", 6), (3, None, None, None)],
                                 "doc_id long, text string, secret_spans string, n_chars int")
    import corpus_pipeline
    kept = corpus_pipeline.no_secrets(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert rows[1]["secret_spans"] == "mine" and "abcdefgh1" not in rows[1]["text"] and rows[1]["n_chars"] == len(rows[1]["text"])
    assert rows[2]["n_chars"] == 6 and rows[3]["text"] is None
    assert corpus_pipeline.no_secrets(spark, docs.where("false").drop("n_chars"), "").collect() == []


def test_url_verdicts_beside_columns_of_any_name(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "b", 1, "h")], "page_id long, url string, best string, shapes int, Host string")
    rules = url_filter.rules_frame(spark, [("org", "/", "allow")])
    row = url_filter.judge_urls(pages, rules).first()
    assert (row["best"], row["shapes"], row["host"], row["rule"]) == ("b", 1, "a.org", "org/")
    assert url_filter.judge_urls(pages.where("false"), rules).collect() == []
