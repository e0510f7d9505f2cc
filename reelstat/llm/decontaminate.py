"""Benchmark decontamination: CGK random walks, bit-sampling LSH, exact edit verification.

Texts and items are sequences of words (A-Z in lower case, ASCII punctuation
removed, each Han, kana or Hangul character a word of its own). A window of a
document that has an item's length matches the item if their edit distance in
words is at most ``max_error`` of the item's length; items of under ``min_words``
words must match without an edit.

1. An item of n words is cut into n // 8 blocks (one at least) of 8 to 15 words.
   Of k edits, one block has at most k // blocks, so long items are found by a
   block with few edits.
2. Each block, and each window of a document with the length of some block, is
   embedded by ``WALKS`` random walks, which turn few edits into few
   differing outputs. A key of a walk is its outputs at ``SAMPLED`` sampled steps;
   windows and blocks that share a key meet in a join.
3. Each pair of a document and an item that met is verified by its exact edit
   distance around the places where they met.

Two filters that lose nothing come before the walks and the join: e edits leave
at least b - 2 - 3e of a block's word triples, so only windows with that many
triples of any item are embedded; and only keys that some block has are written.
Both are bitmaps of fixed size (``SLOTS`` bits), the only things that are broadcast;
items and keys stay in tables.
"""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import hashes, int_arrays, marked, mix, text_blocks, written

#: Walks of each window, and sampled outputs of a walk's key.
WALKS, SAMPLED = 32, 3
#: Words of the shortest block of a longer item.
BLOCK = 8
#: Bits of each bitmap.
SLOTS = 1 << 26
_WIDE = re.compile("([\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af])")
_PUNCTUATION = string.punctuation.encode()
SCHEMA = "doc_id long, item_id long, start_word long, end_word long, edits long, similarity double"


def plain_words(text: str | None) -> list[bytes]:
    """The words of a text in lower case and without ASCII punctuation."""
    if text and _WIDE.search(text):
        text = _WIDE.sub(r" \1 ", text)
    return text.encode("utf-8", "surrogatepass").lower().translate(None, _PUNCTUATION).split() if text else []


def allowed_edits(length: int, max_error: float) -> int:
    return int(length * max_error)


def cgk_keys(windows: np.ndarray, walks: int) -> np.ndarray:
    """Keys (windows, walks) of equally long symbol sequences: the sampled outputs of each random walk."""
    count, length = windows.shape
    padded = np.concatenate([windows, np.zeros((count, 1), np.uint64)], axis=1)
    rng = np.random.default_rng(7 * length + 1)
    steps = 2 * length
    odd = rng.integers(0, 2**63, (steps, walks), np.uint64) * np.uint64(2) + np.uint64(1)
    sampled = np.zeros((steps, walks), bool)
    parts = np.array_split(np.arange(steps - steps // 10), SAMPLED)  # one step of each part, so that a key has words from all over the window
    for walk in range(walks):
        sampled[[rng.choice(part) for part in parts], walk] = True
    at = np.zeros((count, walks), np.int64)
    keys = np.tile(np.arange(walks, dtype=np.uint64), (count, 1))
    rows = np.arange(count)[:, None]
    for step in range(steps):
        symbol = padded[rows, at]
        keys = np.where(sampled[step], mix(keys ^ symbol), keys)
        at = np.minimum(at + ((symbol * odd[step]) >> np.uint64(63)).astype(np.int64), length)
    return keys


def edit_ends(item: np.ndarray, region: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each end in the region, the least edit distance of the item to a part that ends there, and its latest start."""
    width = len(region) + 1
    cost, start = np.zeros(width, np.int64), np.arange(width)
    for i, symbol in enumerate(item):
        above, above_start = cost, start
        change = above[:-1] + (region != symbol)
        down = above[1:] + 1
        take = change <= down
        cost = np.concatenate([[i + 1], np.where(take, change, down)])
        start = np.concatenate([[0], np.where(take, above_start[:-1], above_start[1:])])
        # insertions: cost[j] = min over j' <= j of cost[j'] + j - j'
        slack = cost - np.arange(width)
        lowest = np.minimum.accumulate(slack)
        fresh = np.concatenate([[True], slack[1:] < lowest[:-1]])
        source = np.maximum.accumulate(np.where(fresh, np.arange(width), 0))
        cost, start = lowest + np.arange(width), start[source]
    return cost, start


def best_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the best part of the region: least edit distance, then the earliest end, then the latest start."""
    cost, start = edit_ends(item, region)
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


def _triples(symbols: np.ndarray) -> np.ndarray:
    """A hash for each run of three words."""
    if len(symbols) < 3:
        return symbols[:0]
    return mix((symbols[:-2] * np.uint64(0x9E3779B97F4A7C15) + symbols[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + symbols[2:])


def blocks_of(length: int, edits: int) -> list[tuple[int, int, int]]:
    """(start, words, edits) of an item's blocks; of ``edits`` edits at least one block has no more than its own."""
    count = max(length // BLOCK, 1)
    edges = [length * i // count for i in range(count + 1)]
    return [(a, b - a, edits // count) for a, b in zip(edges, edges[1:], strict=False)]


def _place(key: np.ndarray) -> np.ndarray:
    """The slot of a hash."""
    return (key >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)


def _keys(windows: np.ndarray) -> np.ndarray:
    """LSH keys (windows, walks) of windows of one length; those of different lengths differ."""
    return mix(cgk_keys(windows, WALKS) ^ mix(np.uint64([windows.shape[1]])))


def _item_rows(benchmark: DataFrame, item_id: str, item_text: str, max_error: float, min_words: int, least_words: int) -> DataFrame:
    """(item, item_id, symbols, edits, block, shapes, keys, triples) of the items, written: a number of its own, the words'
    hashes, the allowed edits, the start of each block, its words x 256 + edits, its keys, and the slots of all triples."""

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, stop, texts in text_blocks(batch, "text"):
                rows = []
                for k, text in zip(range(start, stop), texts, strict=True):
                    symbols = hashes(plain_words(text))
                    if len(symbols) < least_words:
                        continue
                    edits = allowed_edits(len(symbols), max_error) if len(symbols) >= min_words else 0
                    blocks = blocks_of(len(symbols), edits)
                    rows.append({"item": number, "item_id": batch.column(0)[k].as_py(), "symbols": symbols.view(np.int64), "edits": edits,
                                 "block": [a for a, _, _ in blocks], "shapes": [n * 256 + min(e, 255) for _, n, e in blocks],
                                 "keys": np.concatenate([_keys(symbols[None, a:a + n])[0] for a, n, _ in blocks]).view(np.int64),
                                 "triples": _place(_triples(symbols))})
                    number += 1
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    longs = pa.list_(pa.int64())
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("symbols", longs), ("edits", pa.int32()), ("block", pa.list_(pa.int32())),
                        ("shapes", pa.list_(pa.int32())), ("keys", longs), ("triples", longs)])
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    return written(rows.mapInArrow(run, "item long, item_id long, symbols array<long>, edits int, block array<int>, shapes array<int>, keys array<long>, triples array<long>"),
                   "leak-items")


class _Windows:
    """Finds the windows of a run of documents that share a key with some block."""

    def __init__(self, triples: np.ndarray, keys: np.ndarray, shapes: list[int]):
        self.shapes = [(x // 256, x % 256) for x in shapes]
        self.longest = max(n + e for n, e in self.shapes)
        self.triples, self.keys = np.zeros(SLOTS, bool), np.zeros(SLOTS, bool)
        self.triples[triples] = True
        self.keys[keys] = True

    def hits(self, symbols: np.ndarray, ends: np.ndarray):
        """(start, key) in the run of documents; ``ends``: where each document's words end."""
        known = np.zeros(len(symbols) + 1, np.int64)
        found = self.triples[_place(_triples(symbols))]
        known[1:len(found) + 1] = found
        for back in (0, 1):  # triples that reach into the next document
            known[np.maximum(ends - back, 0)] = 0
        total = np.cumsum(known)
        if not total[-1]:
            return
        at = np.arange(len(symbols))
        stop = np.repeat(ends, np.diff(ends, prepend=0))  # of each word's document
        for length, edits in self.shapes:
            need = length - 2 - 3 * edits
            last = np.minimum(at + max(length + edits - 2, 0), stop)
            starts = np.flatnonzero(total[last] - total[:-1] >= max(need, 0))
            for part in np.array_split(starts, -(-len(starts) // 20_000)) if len(starts) else ():
                place = part[:, None] + np.arange(length)
                windows = np.where(place < stop[part][:, None], symbols[np.minimum(place, len(symbols) - 1)], 0)
                keys = _keys(windows)
                row, walk = np.nonzero(self.keys[_place(keys)])
                if len(row):
                    yield part[row], keys[row, walk]


def _hit_rows(docs: DataFrame, doc_id: str, text: str, shared) -> DataFrame:
    """(doc, doc_id, symbols, starts, keys) of the documents with a window that shares a key with some block, written."""

    def run(batches):
        windows = _Windows(*shared.value)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, _, texts in text_blocks(batch, "text"):
                by_text = [plain_words(t) for t in texts]
                symbols = hashes([w for ws in by_text for w in ws])
                ends = np.cumsum([len(ws) for ws in by_text])
                found = list(windows.hits(symbols, ends)) if len(symbols) else []
                if not found:
                    continue
                starts, keys = (np.concatenate(x) for x in zip(*found, strict=True))
                owner = np.searchsorted(ends, starts, side="right")
                order = np.argsort(owner, kind="stable")
                owners, first, counts = np.unique(owner[order], return_index=True, return_counts=True)
                low = ends[owners] - [len(by_text[k]) for k in owners]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + len(owners))), pa.array([ids[start + k] for k in owners], pa.int64()),
                     int_arrays(np.concatenate([symbols[a:ends[k]] for a, k in zip(low, owners, strict=True)]).view(np.int64), ends[owners] - low),
                     int_arrays((starts[order] - np.repeat(low, counts)).astype(np.int32), counts), int_arrays(keys[order].view(np.int64), counts)],
                    ["doc", "doc_id", "symbols", "starts", "keys"])
                number += len(owners)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return written(rows.mapInArrow(run, "doc long, doc_id long, symbols array<long>, starts array<int>, keys array<long>"), "leak-windows")


def matches(item: np.ndarray, symbols: np.ndarray, edits: int, places: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, edits) of the matches near the given starts, the best first; overlapping ones count once.

    ``edits`` edits leave all but 3 x ``edits`` of the item's triples in place, so only parts with that many are compared.
    """
    own, need, span = _triples(item), len(item) - 2 - 3 * edits, max(len(item) + edits - 2, 1)
    ordered, found = np.array(sorted(places)), []
    for part in np.split(ordered, np.flatnonzero(np.diff(ordered) > len(item) + 3 * edits) + 1):  # every match near a part lies in one region
        low, high = max(int(part[0]) - edits, 0), min(int(part[-1]) + len(item) + 2 * edits, len(symbols))
        if low >= high:
            continue
        if need > 0:
            total = np.concatenate([[0], np.cumsum(np.isin(_triples(symbols[low:high]), own))])
            if (total[np.minimum(np.arange(len(total)) + span, len(total) - 1)] - total).max() < need:
                continue
        cost, start = edit_ends(item, symbols[low:high])
        ends = np.flatnonzero(cost <= edits)
        found += zip(cost[ends].tolist(), (low + ends).tolist(), (low + start[ends]).tolist(), strict=True)
    taken, out = np.zeros(len(symbols), bool), []
    for cost, end, start in sorted(set(found)):
        if end > start and not taken[start:end].any():
            taken[start:end] = True
            out.append((start, end, cost))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", max_error: float = 0.2, min_words: int = 8, least_words: int = 5) -> DataFrame:
    """One row per match: doc_id, item_id, start_word, end_word (exclusive), edits, similarity (1 - edits / item words).

    Whole texts are searched. Null or empty texts and items match nothing;
    items of under ``min_words`` words match without an edit, those of fewer than ``least_words``
    words are too short to be evidence and are not looked for. Items that
    repeat, or rows that repeat, each give their rows.
    """
    spark = docs.sparkSession
    items = _item_rows(benchmark, item_id, item_text, max_error, min_words, least_words)
    shapes = [r["s"] for r in items.select(F.explode("shapes").alias("s")).distinct().collect()]  # block lengths and their edits
    if not shapes:
        return spark.createDataFrame([], SCHEMA)
    blocks = items.select("item", F.posexplode("keys").alias("n", "key")).join(items.select("item", "block"), "item").select(
        "item", "key", F.get("block", F.floor(F.col("n") / WALKS).cast("int")).alias("block"))
    slot = F.shiftrightunsigned("key", 64 - (SLOTS.bit_length() - 1))
    shared = spark.sparkContext.broadcast((marked(items.select(F.explode("triples").alias("slot")), F.col("slot")),
                                           marked(blocks, slot), sorted(shapes)))
    hits = _hit_rows(docs, doc_id, text, shared)
    met = hits.select("doc", F.explode(F.arrays_zip("starts", "keys")).alias("w")).select("doc", F.col("w.starts").alias("start"), F.col("w.keys").alias("key"))
    pairs = (met.join(blocks, "key").select("doc", "item", (F.col("start") - F.col("block")).alias("place")).distinct()
             .groupBy("doc", "item").agg(F.sort_array(F.collect_list("place")).alias("places")))
    both = pairs.join(hits.select("doc", "doc_id", F.col("symbols").alias("text")), "doc").join(items.select("item", "item_id", "symbols", "edits"), "item")

    def verify(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            symbols, texts, places = columns["symbols"], columns["text"], columns["places"]
            rows = []
            for k in range(batch.num_rows):
                item = np.asarray(symbols[k].values).view(np.uint64)
                for start, end, edits in matches(item, np.asarray(texts[k].values).view(np.uint64), columns["edits"][k].as_py(), places[k].as_py()):
                    rows.append((columns["doc_id"][k].as_py(), columns["item_id"][k].as_py(), start, end, edits, 1 - edits / len(item)))
            if rows:
                found = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found[:5]] + [pa.array(found[5], pa.float64())],
                                                 ["doc_id", "item_id", "start_word", "end_word", "edits", "similarity"])

    return both.select("doc_id", "text", "item_id", "symbols", "edits", "places").mapInArrow(verify, SCHEMA)


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of documents that hold no benchmark passage, all columns kept."""
    leaked = find_leaks(docs, benchmark, doc_id, **options).select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(leaked, doc_id, "left_anti").select(*docs.columns)
