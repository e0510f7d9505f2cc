"""The trie of conversation prefixes by a splitter skeleton.

A conversation is the sequence of its turns (role, text); the nodes of the trie
are the distinct sequences of first turns. Turns are known by 128-bit digests,
so no text is shuffled. A conversation's path, the digests of its turns, is one
row of 20 bytes a turn.

The paths are cut by splitters into shards of consecutive (path, conversation)
keys, so that copies of one conversation, however many, spread over shards too.
A node with members in several shards is a prefix of a splitter's path. These
prefixes, the skeleton, go to every task. Each shard is sorted and read as a
stream: it finishes the nodes that are not of the skeleton, as all of their
members are its own, and gives a partial aggregate for each skeleton node that it
meets. Those are summed by node and accumulated up the skeleton.

Bounds: the skeleton has at most (shards - 1) x ``SPLITTER_TURNS`` nodes; a task
holds the open nodes of one path and the unnamed children of each. One
conversation's path is one row, gathered in one task.

Edge cases: a null role or text is the empty one; a null turn comes first; rows of
one conversation with the same turn are ordered by the digest of role and text;
repeated rows are turns of their own; rows without a conversation id belong to
no conversation; an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import text_blocks, written

#: Bytes of a turn's digest.
DIGEST = 16
#: A splitter's path ends after so many turns.
SPLITTER_TURNS = 1024
#: A shard holds about so many conversations at most.
SHARD_ROWS = 50_000
#: Sampled paths for each shard, of which every so many-th is a splitter.
SAMPLES = 16
#: Characters of conversation ids in one row on their way to a skeleton node.
BLOB = 65_536

_LOCAL = ("kind int, node long, conv_id long, depth long, parent long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "words long, ends string, shard int, block long")


def conversation_paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (digest in hex, words of the text)."""

    def run(batches):
        for batch in batches:
            roles = batch.column(batch.schema.get_field_index("role"))
            for start, stop, texts in text_blocks(batch, "text"):
                digests, words = [], []
                for r, t in zip(roles.slice(start, stop - start).to_pylist(), texts, strict=True):
                    r, t = (r or "").encode("utf-8", "surrogatepass"), (t or "").encode("utf-8", "surrogatepass")
                    digests.append(hashlib.blake2b(b"%d:%b%b" % (len(r), r, t), digest_size=DIGEST).hexdigest())
                    words.append(len(t.split()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start),
                                                  pa.array(digests, pa.string()), pa.array(words, pa.int32())], ["conv_id", "turn", "digest", "words"])

    read = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
                        F.col(text).cast("string").alias("text")).where("conv_id is not null")
    rows = read.mapInArrow(run, f"conv_id long, turn {read.schema['turn'].dataType.simpleString()}, digest string, words int")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def share_heads(paths: DataFrame, base: Column, length: Column, most: int) -> DataFrame:
    """The paths with their first ``length`` (at most ``most``) turns replaced by those of the conversation ``base``
    (all if it has fewer, none if there is no such conversation)."""
    heads = paths.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    asked = paths.select("*", base.alias("base"), length.cast("int").alias("length"))
    none = F.array().cast(paths.schema["turns"].dataType)
    own = F.slice("turns", F.col("length") + 1, F.size("turns") + F.lit(1))
    return asked.join(heads, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("length")), own).alias("turns"))


class Skeleton:
    """The trie of the splitters' paths; splitters are sorted (path, conversation) keys."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.parent, self.depth = [-1], [0]
        self.ids: list[list[int]] = []  # node of each splitter at each depth
        before, path_ids = b"", [0]
        for path, _ in splitters:
            path_ids = path_ids[:shared_turns(before, path) + 1]
            while len(path_ids) <= len(path) // DIGEST:
                self.parent.append(path_ids[-1])
                self.depth.append(len(path_ids))
                path_ids = [*path_ids, len(self.parent) - 1]
            self.ids.append(path_ids)
            before = path

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def nodes(self, shard: int, path: bytes) -> list[int]:
        """Skeleton nodes on a path of the shard, from the root. Only the splitters on both sides can share more with it."""
        found = [0]
        for s in (shard - 1, shard):
            if 0 <= s < len(self.splitters):
                n = shared_turns(self.splitters[s][0], path)
                if n >= len(found):
                    found = self.ids[s][:n + 1]
        return found


def shared_turns(a: bytes, b: bytes) -> int:
    """Number of first turns that two paths share."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * DIGEST:mid * DIGEST] == b[low * DIGEST:mid * DIGEST]:
            low = mid
        else:
            high = mid - 1
    return low


class _Node:
    """An open node of a shard."""

    __slots__ = ("block", "children", "depth", "ends", "leaves", "least", "n", "saved", "skeleton", "text", "waiting", "words")

    def __init__(self, depth: int, words: int, skeleton: int):
        self.depth, self.words, self.skeleton = depth, words, skeleton
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends = self.text = None  # of a local node a running hash, of a skeleton node the pieces of a row
        self.block, self.waiting = 0, []  # waiting: closed children, for this node's least member


class _Shard:
    """Reads one shard's sorted conversations; ``rows`` gathers what is finished."""

    def __init__(self, shard: int, skeleton: Skeleton):
        self.shard, self.skeleton, self.rows, self.open, self.path = shard, skeleton, [], [], b""

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        shared = shared_turns(self.path, path) if self.open else -1
        self.close(shared)
        if len(self.open) <= len(words):
            known = self.skeleton.nodes(self.shard, path)
            for depth in range(len(self.open), len(words) + 1):
                self.open.append(_Node(depth, words[depth - 1] if depth else 0, known[depth] if depth < len(known) else -1))
        self.path = path
        node, name = self.open[-1], str(conv_id)
        node.n += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        if node.skeleton < 0:
            if node.ends is None:
                node.ends = hashlib.sha256(name.encode())
            else:
                node.ends.update(b"," + name.encode())
        else:
            node.text = node.text or []
            node.text.append(name)
            if len(node.text) * 8 >= BLOB:
                self.send_ends(node)

    def send_ends(self, node: _Node) -> None:
        if node.text:
            self.rows.append((3, node.skeleton, *[None] * 8, ",".join(node.text), self.shard, node.block))
            node.block, node.text = node.block + 1, None

    def close(self, depth: int = -1) -> None:
        """Closes the open nodes deeper than ``depth``."""
        while len(self.open) > depth + 1:
            node = self.open.pop()
            above = self.open[-1] if self.open else None
            if above:
                above.n += node.n
                above.least = node.least if above.least is None else min(above.least, node.least)
            if node.skeleton >= 0:
                self.send_ends(node)
                self.rows.append((2, node.skeleton, node.least, node.depth, None, node.n, node.children, node.leaves, node.saved, node.words, None, None, None))
                continue
            self.rows += [(0, None, *child[:2], node.least, *child[2:6], None, child[6], None, None) for child in node.waiting]
            leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.words
            ends = (node.ends or hashlib.sha256()).hexdigest()
            row = (node.least, node.depth, node.n, node.children, leaves, saved, ends)
            above.children, above.leaves, above.saved = above.children + 1, above.leaves + leaves, above.saved + saved
            if above.skeleton >= 0:
                self.rows.append((1, None, *row[:2], above.skeleton, *row[2:6], None, ends, None, None))
            else:
                above.waiting.append(row)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 9, pa.string(), pa.int32(), pa.int64()]
    names = [x.split()[0] for x in _LOCAL.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _splitters(paths: DataFrame, partitions: int) -> list[tuple[bytes, int]]:
    """Splitters of a hash sample: at most one less than the shards, each path cut to ``SPLITTER_TURNS``."""
    total = paths.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0)).alias("b")).first()
    shards = max(min(partitions, total["n"] // 100), -(-total["n"] // SHARD_ROWS), total["b"] >> 26, 1)
    share = min(SAMPLES * shards * 2 ** 64 // max(total["n"], 1), 2 ** 64 - 1)
    sample = paths.where(F.xxhash64("conv_id") <= share - 2 ** 63)
    found = sorted((bytes(r["p"]), r["conv_id"]) for r in sample.select(F.substring("path", 1, SPLITTER_TURNS * DIGEST).alias("p"), "conv_id").collect())
    return sorted({found[i * len(found) // shards] for i in range(1, shards)}) if found else []


def trie_nodes(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, turns): conv_id (its smallest member), depth, parent_conv_id (the same
    of its parent; root: null), n_convs, n_children, n_leaves, saved_tokens and ends_sha256 (SHA-256 of the decimal ids,
    ascending and joined by commas, of the conversations that end at it). saved_tokens: summed over the node's subtree,
    the words of a node's last text times its members but one.
    """
    spark = paths.sparkSession
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = written(paths.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")), "trie-paths")
    skeleton = Skeleton(_splitters(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shared = spark.sparkContext.broadcast(skeleton)

    def assign(batches):
        for batch in batches:
            at = [shared.value.shard(bytes(p), c) for c, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "shard"])

    def finish(batches):
        shard = None
        for batch in batches:
            for conv_id, path, words, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard is None or number != shard.shard:
                    if shard is not None:
                        shard.close()
                        yield _batch(shard.rows)
                    shard = _Shard(number, shared.value)
                shard.add(conv_id, bytes(path), words)
                if len(shard.rows) >= 10_000:
                    yield _batch(shard.rows)
                    shard.rows = []
        if shard is not None:
            shard.close()
            yield _batch(shard.rows)

    dealt = rows.mapInArrow(assign, "conv_id long, path binary, words array<int>, shard int")
    dealt = dealt.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    local = written(dealt.mapInArrow(finish, _LOCAL), "trie-local")

    whole = spark.createDataFrame(_skeleton_rows(local, skeleton), "node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                                                   "n_leaves long, saved_tokens long, ends_sha256 string")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    renamed = local.withColumnsRenamed({"parent": "parent_conv_id", "ends": "ends_sha256"})
    above = whole.select(F.col("node").alias("parent_conv_id"), F.col("conv_id").alias("above"))
    below = renamed.where("kind = 1").join(F.broadcast(above), "parent_conv_id").drop("parent_conv_id").withColumnRenamed("above", "parent_conv_id")
    return renamed.where("kind = 0").select(columns).unionAll(below.select(columns)).unionAll(whole.select(columns))


def _skeleton_rows(local: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """The skeleton's nodes with members: partial aggregates summed by node, then accumulated from the deepest up."""

    def digest(batches):
        node, state = None, None
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != node:
                    if state is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "sha"])
                    node, state = number, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "sha"])

    parts = (local.where("kind = 2").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n"), F.sum("n_children").alias("children"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"), F.max("words").alias("words")).collect())
    ends = local.where("kind = 3").select("node", "ends", "shard", "block").repartition("node").sortWithinPartitions("node", "shard", "block")
    hashed = {r["node"]: r["sha"] for r in ends.select("node", "ends").mapInArrow(digest, "node long, sha string").collect()}
    nodes = {r["node"]: r.asDict() for r in parts}
    out = []
    for number in sorted(nodes, reverse=True):  # a child's number is above its parent's
        node, above = nodes[number], nodes.get(skeleton.parent[number])
        node["leaves"] = node["leaves"] if node["children"] else 1
        node["saved"] += (node["n"] - 1) * node["words"]
        if above:
            above["children"] += 1
            above["leaves"] += node["leaves"]
            above["saved"] += node["saved"]
        out.append((number, node["conv_id"], skeleton.depth[number], above["conv_id"] if above else None, node["n"], node["children"], node["leaves"],
                    node["saved"], hashed.get(number) or hashlib.sha256().hexdigest()))
    return out
