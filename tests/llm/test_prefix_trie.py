"""The conversation trie against a plain trie of dictionaries."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from reelstat.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn int, role string, text string, node int, path string, shard int"


def brute_paths(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in by_conv.items()}


def brute_shared(paths):
    out = {}
    for c, own in paths.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(c % 20 if c >= 0 else -(-c % 20))
        out[c] = paths.get(base, [])[:h] + own[h:]
    return out


def brute_nodes(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    rows = []
    for node, ids in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        ends = sorted(c for c in ids if len(paths[c]) == len(node))
        leaves = [n for n in below if not any(m[:len(n)] == n and len(m) == len(n) + 1 for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode().split()) for n in below if n)
        rows.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children), len(leaves), saved,
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


def random_turns(seed, convs, longest=7):
    """Conversations over few texts, so that many share turns; no two turns of one conversation tie."""
    rng = random.Random(seed)
    rows = []
    for c in convs:
        start = rng.choice([0, 0, 3])
        for t in range(rng.randint(1, longest)):
            rows.append((c, None if t == 0 and start else start + t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "Hi there you", "", None, "a\tb\x0bc d", "é ü"])))
    rng.shuffle(rows)
    return rows


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, 1, "p", 2) for r in rows], SCHEMA).repartition(partitions)


def nodes_of(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_equals_a_plain_trie(spark, monkeypatch, shards):
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", max(1, 120 // shards))
    rows = random_turns(shards, [*range(90), *range(-30, 0)])
    paths = prefix_trie.conversation_paths(frame(spark, rows))
    assert nodes_of(prefix_trie.trie_nodes(paths)) == brute_nodes(brute_paths(rows))


def test_heads_of_another_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 30)
    rows = random_turns(5, [c for c in range(110) if c % 7], longest=4)  # some bases are absent, some conversations end up without turns
    paths = prefix_trie.conversation_paths(frame(spark, rows))
    c = F.col("conv_id")
    shared = prefix_trie.share_heads(paths, c - c % 20, F.crc32(c.cast("string").cast("binary")) % 4, most=3)
    expected = brute_shared(brute_paths(rows))
    assert any(not path for path in expected.values())
    assert nodes_of(prefix_trie.trie_nodes(shared)) == brute_nodes(expected)


def test_copies_spread_over_shards_and_long_conversations(spark, monkeypatch):
    """500 copies of one conversation, two of 300 turns that part at the last, and a blob of ids in many rows."""
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 40)
    monkeypatch.setattr(prefix_trie, "BLOB", 64)
    rows = [(c, t, "user", f"same {t}") for c in range(500) for t in range(3)] + [(500 + c, 0, "user", "same 0") for c in range(30)]
    rows += [(1000 + c, t, "user", f"long {t}" if t < 299 else f"end {c}") for c in range(2) for t in range(300)]
    paths = prefix_trie.conversation_paths(frame(spark, rows)).checkpoint()
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    assert len(prefix_trie._splitters(paths.select("conv_id", path.alias("path")), 4)) >= 10
    found = {(r[0], r[1]): r for r in nodes_of(prefix_trie.trie_nodes(paths))}
    ends = hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()
    assert found[0, 0][3:5] == (532, 2) and found[0, 3] == (0, 3, 0, 500, 0, 1, 998, ends)
    assert found[0, 1][3:7] == (530, 1, 1, 529 * 2 + 499 * 4) and found[1000, 299][3:7] == (2, 2, 2, 2)
    assert found[1000, 1][3:7] == (2, 1, 2, 299 * 2) and len(found) == 1 + 3 + 301


def test_ties_repeats_nulls_and_empty(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "b", "x"), (2, 0, "a", "y"), (3, 0, "a", "y"), (3, 0, "b", "x"), (None, 0, "user", "a"), (4, None, None, None)]
    found = nodes_of(prefix_trie.trie_nodes(prefix_trie.conversation_paths(frame(spark, rows))))
    depth = {(r[0], r[1]): r for r in found}
    assert depth[1, 2][3] == 1  # a repeated row is a turn of its own
    assert depth[2, 2][3] == 2  # tied turns have one order, whatever that of their rows
    assert depth[4, 1][3] == 1 and depth[1, 0][3] == 4
    assert prefix_trie.trie_nodes(prefix_trie.conversation_paths(frame(spark, rows).where("false"))).collect() == []


def test_very_long_text_and_other_names(spark):
    rows = [(1, 1, "user", "w " * 1_500_000), (2, 1, "user", "w " * 1_500_000)]
    named = frame(spark, rows).select(F.col("conv_id").alias("c"), F.col("turn").alias("n"), F.col("role").alias("who"), F.col("text").alias("said"), F.lit(1).alias("conv_id"))
    found = nodes_of(prefix_trie.trie_nodes(prefix_trie.conversation_paths(named, "c", "n", "who", "said")))
    assert [r[6] for r in found] == [1_500_000, 1_500_000]
