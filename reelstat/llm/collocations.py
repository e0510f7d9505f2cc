"""Collocations of each language by dynamic itemset counting.

The texts are dealt into shards that are scanned in turn, round and round. Words
are counted from the first scan on. A longer phrase joins the scans as soon as
both its subphrases (without the last word, without the first) have been seen
often enough, and is counted for one full cycle of shards from there. So lengths
are counted side by side, in far fewer scans than one cycle for each length, and
each count covers all texts.

Which phrases have joined is known from a map of fixed size: a phrase's hash names
its slot, the slot holds the scan before which a phrase of that slot first reached
the threshold. A phrase joins at the later of its subphrases' two scans. Phrases that
share a slot may let rare ones join; those are counted as exactly and dropped
at the end, so the map's size changes the work and never the result. The map
(``SLOTS`` bytes) is the only thing that is broadcast, newly reached slots (a
bit for each) the only thing that comes to the driver.

While they are counted, phrases are known by hashes of their words and
language, made in numpy from the bytes of a block. 96 of their 128 bits leave a task: among 10^10 phrases
two share them with a probability under 10^-8, and a row is shuffled and written in a fifth less space.
At the end the texts of the frequent ones are looked
up in growing parts of the corpus, each part for those that no part before held; a hash
that stood for two texts of a part would raise an error there.

Edge cases: a null text is empty, a null language is ``und``; repeated rows count
again; a text longer than a block is counted piece by piece; without a phrase that
is frequent enough the result is empty; other columns are not read.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelstat.llm.common import drop_folder, hashes, marked, mix, shared_folder, text_blocks
from reelstat.llm.wordhash import BASES, word_hashes

#: Slots of the map of phrases that have reached the threshold, one byte each.
SLOTS = 1 << 24
#: Shards of a cycle, and parts of a shard.
SHARDS, PARTS = 4, 2
#: Words of the longest phrase.
LONGEST = 4
#: Words that a task gathers before it counts their phrases.
RUN_WORDS = 600_000
_NEVER = 255
#: Spark's setting by which shuffle files go when their query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What a byte is: part of a word, a gap, or the end of a piece.
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b" \t")] = 1
_KINDS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2


class _Run:
    """The words of some texts of one language; ``texts`` keeps their bytes where phrases are to be written out."""

    def __init__(self, lang: str, texts: bool = False):
        self.lang, self.texts, self.held, self.size, self.pieces = lang, [] if texts else None, [], 0, 0

    def add(self, texts: list) -> None:
        data = b"\n".join(t.encode("utf-8", "surrogatepass") for t in texts if t)
        found, piece, starts, ends = word_hashes(data, _KINDS)
        self.held.append((found, piece + self.pieces, starts, ends, np.full(len(starts) if self.texts is not None else 0, len(self.held))))
        self.size += len(starts)
        self.pieces += int(piece[-1]) + 1 if len(piece) else 1
        if self.texts is not None:
            self.texts.append(data)

    def phrases(self):
        """(length, hashes in two rows, same piece, start) by length; hashes of length 0 stand for all words of the language."""
        found = np.concatenate([h[0] for h in self.held], axis=1)
        piece = np.concatenate([h[1] for h in self.held])
        seed = hashes([self.lang.encode() + b"|%d" % i for i in range(2)])[:, None]
        yield 0, seed, np.ones(1, bool)
        word = mix(found ^ seed)
        state = word
        for length in range(1, min(LONGEST, len(piece)) + 1):
            if length > 1:
                state = mix(state[:, :-1] * BASES[1] + word[:, length - 1:])
            yield length, state, piece[:state.shape[1]] == piece[length - 1:]

    @cached_property
    def _places(self) -> tuple:
        return tuple(np.concatenate([h[i] for h in self.held]) for i in (4, 2, 3))

    def text(self, position: int, length: int) -> str:
        of, starts, ends = self._places
        data = self.texts[of[position]]
        return b" ".join(data[starts[p]:ends[p]].lower() for p in range(position, position + length)).decode("utf-8", "surrogatepass")


def slots_of(state: np.ndarray, slots: int) -> np.ndarray:
    return (state >> np.uint64(64 - (slots.bit_length() - 1))).astype(np.int64)


def _halves(state: np.ndarray) -> list[pa.Array]:
    """What is kept of the two rows of hashes outside a task: 64 bits and 32 bits."""
    return [pa.array(state[0].view(np.int64)), pa.array((state[1] >> np.uint64(32)).astype(np.uint32).view(np.int32))]


def _grouped(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, number) of each different column of two rows of hashes."""
    code, _ = pd.factorize(state[0])
    first = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    if (state[1][first[code]] != state[1]).any():  # one half of a hash is not enough here
        _, first, code = np.unique(state, axis=1, return_index=True, return_inverse=True)
    return first, np.bincount(code.ravel(), minlength=len(first))


def phrase_counts(run: _Run, reached: np.ndarray, scan: int, shards: int):
    """(length, hashes, scans at which they joined, counts) of the phrases that this scan counts, by length."""
    slots = None
    for length, state, whole in run.phrases():
        if length > 1:
            before = reached[slots].astype(np.int64)
            since = np.maximum(before[:-1], before[1:])
        else:
            since = np.zeros(state.shape[1], np.int64)  # words join at the first scan
        slots = slots_of(state[0], len(reached))
        at = np.flatnonzero(whole & (since <= scan) & (scan < since + shards))
        if not len(at):
            continue
        first, counts = _grouped(state[:, at])
        if not length:
            counts = np.array([run.size])
        yield length, state[:, at[first]], since[at[first]], counts


def _runs(batches, texts: bool = False):
    """Runs of words of one language each, of about ``RUN_WORDS`` words."""
    held: dict[str, _Run] = {}
    words = 0
    for batch in batches:
        for start, stop, block in text_blocks(batch, "text"):
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column(0).slice(start, stop - start).to_pylist(), block, strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, group in by_lang.items():
                run = held.setdefault(lang, _Run(lang, texts))
                words -= run.size
                run.add(group)
                words += run.size
            if words >= RUN_WORDS:
                yield from (r for r in held.values() if r.size)
                held, words = {}, 0
    yield from (r for r in held.values() if r.size)


def _scanned(docs: DataFrame, reached, scan: int, shards: int) -> DataFrame:
    """(a, b, length, since, c) of a shard, for the phrases that the scan counts; a and b: their hash."""

    def run(batches):
        for words in _runs(batches):
            for length, state, since, counts in phrase_counts(words, reached.value, scan, shards):
                n = len(counts)
                for i in range(0, n, 200_000):
                    cut = slice(i, i + 200_000)
                    m = len(counts[cut])
                    yield pa.RecordBatch.from_arrays(
                        [*_halves(state[:, cut]), pa.array(np.full(m, length, np.int32)),
                         pa.array(since[cut].astype(np.int32)), pa.array(counts[cut].astype(np.int64))], ["a", "b", "length", "since", "c"])

    return docs.select("lang", "text").mapInArrow(run, "a long, b int, length int, since int, c long")


def _written_out(docs: DataFrame, frequent) -> DataFrame:
    """(a, b, lang, phrase) of the phrases whose slots are marked as frequent, in the order of no rows in particular."""

    def run(batches):
        for words in _runs(batches, texts=True):
            for length, state, whole in words.phrases():
                at = np.flatnonzero(whole & frequent.value[slots_of(state[0], len(frequent.value))])
                first = at[_grouped(state[:, at])[0]] if len(at) else at
                texts = [words.text(p, length) for p in first.tolist()]
                yield pa.RecordBatch.from_arrays([*_halves(state[:, first]), pa.array([words.lang] * len(first), pa.string()), pa.array(texts, pa.string())], ["a", "b", "lang", "phrase"])

    return docs.select("lang", "text").mapInArrow(run, "a long, b int, lang string, phrase string")


def frequent_phrases(docs: DataFrame, least: int = 30, lang: str = "lang", text: str = "text", shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(lang, length, phrase, c): the phrases of 1 to ``LONGEST`` words that occur ``least`` times or more, by language,
    and for each language the empty phrase (length 0) with the number of all its words. ``slots``: a power of 2."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "phrase-shards")
    (docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"),
                 (F.monotonically_increasing_id() % (shards * PARTS)).cast("int").alias("shard")).where("text is not null")
     .write.partitionBy("shard").parquet(folder))
    texts = spark.read.schema("lang string, text string, shard int").parquet(folder)
    slot = F.shiftrightunsigned("a", 64 - (slots.bit_length() - 1))
    reached, last = np.full(slots, _NEVER, np.uint8), 0
    counted, path, scan = None, None, 0
    while scan < last + shards:  # some phrase may still be in its cycle
        sent = spark.sparkContext.broadcast(reached)
        first = scan % shards * PARTS
        rows = _scanned(texts.where(F.col("shard").between(first, first + PARTS - 1)), sent, scan, shards)
        together = rows if counted is None else rows.unionAll(counted)
        together = together.groupBy("a", "b", "length", "since").agg(F.sum("c").alias("c"))
        open_yet = F.col("since") + shards - 1 > scan
        counted, path, old = *_kept(spark, together.where(open_yet | (F.col("c") >= least) | (F.col("length") == 0))), path
        if old:
            drop_folder(spark, old)
        sent.destroy()
        scan += 1
        new = marked(counted.where((F.col("c") >= least) & F.col("length").between(1, LONGEST - 1)), slot)
        new = new[reached[new] == _NEVER]
        if len(new):
            reached = reached.copy()
            reached[new], last = scan, scan
    counted = counted.where((F.col("c") >= least) | (F.col("length") == 0))
    found, open_rows, low = spark.createDataFrame([], "lang string, length int, phrase string, c long"), counted.select("a", "b", "length", "c"), 0
    while low < shards * PARTS and len(places := marked(open_rows, slot)):
        high = max(2 * low, low + 1)  # as much of the texts again as all parts before
        wanted = np.zeros(slots, bool)
        wanted[places] = True
        sent = spark.sparkContext.broadcast(wanted)
        named, _ = _kept(spark, _named(open_rows, _written_out(texts.where(F.col("shard").between(low, high - 1)), sent)))
        sent.destroy()
        found = found.unionAll(named.where("phrase is not null").select("lang", "length", "phrase", "c"))
        open_rows, low = named.where("phrase is null").select("a", "b", "length", "c"), high
    drop_folder(spark, path)
    drop_folder(spark, folder)
    return found


def _named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """The rows (a, b, length, c) with lang and phrase, null where the names (a, b, lang, phrase) have none."""
    both = rows.join(names, ["a", "b"], "left").groupBy("a", "b", "length", "c").agg(
        F.min("lang").alias("lang"), F.min("phrase").alias("phrase"), F.max("lang").alias("l"), F.max("phrase").alias("p"))
    differ = (F.col("l") != F.col("lang")) | (F.col("p") != F.col("phrase"))
    error = F.raise_error(F.concat(F.lit("one hash of two phrases: "), "phrase", F.lit(" / "), "p")).cast("string")
    return both.select("a", "b", "length", "c", "lang", F.when(differ, error).otherwise(F.col("phrase")).alias("phrase"))


def _kept(spark: SparkSession, df: DataFrame) -> tuple[DataFrame, str]:
    """The frame, written and read back, and its folder. What it shuffled is removed at once, not when the driver's JVM
    next collects garbage: shuffles of many scans would lie on disk together."""
    path = shared_folder(spark, "phrase-counts")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more; ``counts`` as ``frequent_phrases`` gives
    them. l and r are the counts of both parts at the cut of the lowest score, floor(2000000 a / (l + r)); the first of
    such cuts. Phrases that occur inside a longer one at least four fifths as frequent are left out."""
    phrases = counts.where("length >= 2").select("lang", "phrase", "length", F.col("c").alias("a"), F.split("phrase", " ", -1).alias("w"))

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    inner = phrases.where("length >= 3").select("lang", "a", F.explode(F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("length") - 1),
        lambda k: F.transform(F.sequence(F.lit(1), F.col("length") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " ")))))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = phrases.join(longer, ["lang", "phrase"], "left").where(
        "longer is null or cast(longer as decimal(38,0)) * 100 < cast(a as decimal(38,0)) * 80").drop("longer")
    cuts = free.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("length")).alias("right"))
    known = counts.where(f"length between 1 and {LONGEST - 1}")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("c").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("c").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr("(cast(a as decimal(38,0)) * 2000000) div (cast(l as decimal(38,0)) + r)").cast("long"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    words = counts.where("length = 0").select("lang", F.col("c").alias("n"))
    return best.join(words, "lang").select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def top_collocations(docs: DataFrame, most: int = 2_000, least: int = 30, lang: str = "lang", text: str = "text") -> DataFrame:
    """The ``most`` phrases of each language by score, then count, then text, with their rank from 1."""
    found = scored(frequent_phrases(docs, least, lang, text))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
