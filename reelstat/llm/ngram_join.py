"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct word 5-grams. Its
parity sketch deals the set to p parts by the leading bits of each hash and
keeps the XOR of every part: an element that only one of two documents has
changes one part, so the number of differing parts never exceeds the symmetric
difference. Sets a <= b with similarity t differ in at most
D = (a + b)(1 - t)/(1 + t) elements, so at least (filled parts - D) filled parts
are equal: two documents that each publish their first D + 1 filled parts, in
one order that all documents share, have one in common (pigeonhole, exact).

Size bands: band j has p = 4^j parts and serves the pairs whose smaller set has
0.4 x 4^j to 1.6 x 4^j elements. A document publishes in its own band and, if
its smallest partner would be in the band below, there too. The shared order
puts parts of only common 5-grams last (passages that many documents share;
any set of 5-grams gives right results here, a good one few false pairs) and
then parts of many elements first, as a part of one element matches wherever
that phrase occurs. A document with too few filled parts publishes them all
and repeats the sketch with four times the parts, up to one element a part, so
that two such documents meet there.

Pairs: the documents of one published part are sorted; each is paired with the
first (its hub), which is linear in the group. These pairs are verified on the
whole texts. Where a pair with the hub fails, the members that are still in
different components are paired with each other and verified too, so that no
link that joins two components is lost. Components come from the verified
links. Equal sets within one task are recognised by a 128-bit digest of the
sorted set and only the first one publishes parts, which bounds a group of
copies by the number of tasks.

The second pairing compares whole-document sketches (two to four bits an
element) inside the tasks: their Hamming distance is at most the symmetric
difference, so only pairs that can be similar enough leave a task. A part that
many documents publish is dealt out in blocks, each pair of blocks to a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import flat, gathered, hashes, lower_words, mix, most_frequent, text_blocks, written
from reelstat.llm.components import component_ids

WORDS = 5
_LOAD = 1.6  # most elements a part, on average, in a band
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F], np.uint64)


def shingle_sets(texts: list, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams, A-Z in lower case.

    A text of fewer words is one shingle, its whole sequence; without words the set is empty.
    """
    by_text = [lower_words(t) for t in texts]
    word = hashes([w for ws in by_text for w in ws])
    total = np.zeros(max(len(word) - n + 1, 0), np.uint64)
    for i in range(n):
        total += mix(word[i:len(word) - n + 1 + i] if len(total) else word[:0]) * _MULTIPLIERS[i % 5] if len(total) else 0
    total = mix(total)
    out, at = [], 0
    for ws in by_text:
        if len(ws) >= n:
            out.append(np.unique(total[at:at + len(ws) - n + 1]))
        elif ws:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(ws), seed=len(ws))], np.uint64))
        else:
            out.append(word[:0])
        at += len(ws)
    return out


def _published(elements: np.ndarray, common: np.ndarray, bits: int, wanted: int) -> tuple[np.ndarray, bool]:
    """The first ``wanted`` filled parts of a sketch of 2^bits parts; whether there were enough."""
    if bits >= 60:
        parts, held, shared = elements, 0, common
    else:
        part = elements >> np.uint64(64 - bits) if bits else np.zeros(len(elements), np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        parts = np.bitwise_xor.reduceat(mix(elements), starts)
        held = np.diff(np.append(starts, len(elements)))
        shared = np.logical_and.reduceat(common, starts)
    if len(parts) <= wanted:
        return parts, len(parts) == wanted
    order = np.lexsort((parts, -(held + np.zeros(len(parts), np.int64)), shared))
    return parts[order[:wanted]], True


def signatures(elements: np.ndarray, common: np.ndarray, percent: int = 75) -> np.ndarray:
    """The parts that a document with this set publishes, as non-negative 63-bit values; common: a flag per element."""
    n = len(elements)
    if not n:
        return elements.astype(np.int64)

    def wanted(other: int) -> int:  # D + 1 against a partner of this size
        return (n + other) * (100 - percent) // (100 + percent) + 1

    band = 1
    while n >= int(_LOAD * 4 ** band):
        band += 1
    needs = [(band, wanted(n * 100 // percent))]
    below = int(_LOAD * 4 ** (band - 1)) - 1  # the largest set of the band below
    if band > 1 and -(-n * percent // 100) <= below:
        needs.append((band - 1, wanted(below)))
    out = []
    for j, want in needs:
        bits, enough = 2 * j, False
        while not enough:
            parts, enough = _published(elements, common, bits, want)
            out.append(mix(parts ^ np.uint64(bits)))
            bits = bits + 2 if bits + 2 < 24 else 64
    return (np.unique(np.concatenate(out)) >> np.uint64(1)).astype(np.int64)


def sketch(elements: np.ndarray) -> bytes:
    """Parity sketch of 64 x 2^k bits, at least two an element; folding one in half by XOR gives the next smaller."""
    bits = 64
    while bits < 2 * len(elements):
        bits *= 2
    odd = np.bincount((mix(elements) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _near(members: list[tuple], others: list[tuple] | None, percent: int) -> list[tuple]:
    """Pairs of ids (id, component, size, sketch) of different components whose sketches allow the similarity.

    ``others`` None: pairs within ``members``. Of equal sets only the first is compared, the rest is paired with it.
    """
    out, firsts = [], {}
    for side, rows in enumerate([members] if others is None else [members, others]):
        for m in rows:
            first = firsts.setdefault(m[3][:16], (side, m))[1]
            if first is not m and first[0] != m[0]:
                out.append((min(first[0], m[0]), max(first[0], m[0])))
    width = min((len(m[3]) for _, m in firsts.values()), default=0) - 16

    def side_of(which):
        rows = [m for s, m in firsts.values() if s == which]
        folded = np.zeros((len(rows), width), np.uint8)
        for k, m in enumerate(rows):
            folded[k] = np.bitwise_xor.reduce(np.frombuffer(m[3], np.uint8)[16:].reshape(-1, width))
        return (np.array([m[0] for m in rows], np.int64), np.array([m[1] for m in rows], np.int64),
                np.array([m[2] for m in rows], np.int64), folded.view(np.uint64))

    a = side_of(0)
    b = a if others is None else side_of(1)
    for k in range(len(a[0])):
        rest = slice(k + 1, None) if others is None else slice(None)
        ids, components, sizes, bits = (x[rest] for x in b)
        distance = np.bitwise_count(bits ^ a[3][k]).sum(axis=1)
        fits = ((components != a[1][k]) & (distance * (100 + percent) <= (sizes + a[2][k]) * (100 - percent))
                & (np.minimum(sizes, a[2][k]) * 100 >= np.maximum(sizes, a[2][k]) * percent))
        out += [(min(a[0][k], i), max(a[0][k], i)) for i in ids[fits]]
    return out


def _allowed(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches allow the similarity; sizes: (id, n, sketch)."""
    both = (pairs.join(sizes.toDF("a", "n_a", "sketch_a"), "a").join(sizes.toDF("b", "n_b", "sketch_b"), "b")
            .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
            .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"))

    def run(batches):
        for batch in batches:
            out = [(a, b) for a, b, n_a, n_b, x, y in zip(*(col.to_pylist() for col in batch.columns))
                   if _near([(a, a, n_a, x)], [(b, b, n_b, y)], percent)]
            if out:
                yield _pair_batch(out)

    return both.mapInArrow(run, "a long, b long").distinct()


def _cross_pairs(placed: DataFrame, held: DataFrame, percent: int, block: int = 512) -> DataFrame:
    """Distinct pairs (a, b) of rows (sig, id, c) of one sig that can be linked across components c; held: (id, n, sketch)."""
    blocks = placed.groupBy("sig").agg(F.expr(f"cast(ceil(count(*) / {block}) as int)").alias("blocks"))
    dealt = (placed.join(blocks, "sig").join(held, "id").withColumn("own", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("sig", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "id", "c", "n", "sketch"))
    dealt = dealt.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi", "own")

    def run(batches):
        key, held = None, []

        def pairs():
            lo = [m for own, m in held if own == key[1]]
            hi = [m for own, m in held if own == key[2]]
            return _near(lo, None if key[1] == key[2] else hi, percent)

        for batch in batches:
            out = set()
            for sig, lo, hi, own, i, c, n, sk in zip(*(col.to_pylist() for col in batch.columns)):
                if (sig, lo, hi) != key:
                    out.update(pairs() if held else ())
                    key, held = (sig, lo, hi), []
                held.append((own, (i, c, n, sk)))
            if out:
                yield _pair_batch(out)
        if held and (out := pairs()):
            yield _pair_batch(out)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _pair_batch(pairs) -> pa.RecordBatch:
    at = np.array(sorted(set(pairs)), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], ["a", "b"])


def common_shingles(docs: DataFrame, text: str = "text", n: int = WORDS, together: int = 2, least: int = 8,
                    most: int = 500_000) -> np.ndarray:
    """Sorted hashes of the n-grams of at least ``least`` documents, at most the ``most`` most frequent ones.

    Every document counts; a task passes on what at least ``together`` of the
    different sets of some 24 million characters hold. Only the order in which parts are published
    depends on this array of at most ``most`` values, never a result.
    """

    def run(batches):
        for many in gathered(batches, "text", 24_000_000):
            sets, seen = [], set()
            for at in range(0, len(many), 500):
                for elements in shingle_sets(many[at:at + 500], n):
                    if (digest := xxhash.xxh3_128_digest(elements.tobytes())) not in seen:
                        seen.add(digest)
                        sets.append(elements)
            together_all = flat(sets, np.uint64)
            del sets
            together_all.sort()
            repeated = together_all[1:][together_all[1:] == together_all[:-1]]  # each value once less than it occurs
            values, counts = np.unique(repeated, return_counts=True)
            counts = counts + 1
            often = counts >= together
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], ["h", "c"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    return np.sort(most_frequent(written(counted.where(F.col("c") >= least), "ngram-common"), "h", "c", most)[0].view(np.uint64))


def _is_common(elements: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(elements), bool)
    return common[np.minimum(np.searchsorted(common, elements), len(common) - 1)] == elements


def _publish(docs: DataFrame, doc_id: str, text: str, percent: int, n: int, common: np.ndarray) -> DataFrame:
    """Rows (sig, id, rep, sketch). Every input row gives one row with a negative sig that holds its set's size,
    its first equal within the task as rep, and its set's digest and sketch; the first of equals also gives a row for each published part."""

    def run(batches):
        firsts: dict[bytes, int] = {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, _, texts in text_blocks(batch, "text"):
                sizes, reps, own, parts, sketches = [], [], [], [], []
                sets = shingle_sets(texts, n)
                ends = np.cumsum([len(x) for x in sets])
                marks = np.split(_is_common(flat(sets, np.uint64), common), ends[:-1])
                for k, elements in enumerate(sets):
                    i = ids[start + k]
                    rep, digest = i, xxhash.xxh3_128_digest(elements.tobytes())
                    sketches.append(digest + sketch(elements))
                    if i is not None and len(elements):
                        rep = firsts.setdefault(digest, i)
                        if rep == i:
                            parts.append(signatures(elements, marks[k], percent))
                            own.append(i)
                    sizes.append(len(elements))
                    reps.append(rep)
                mine = ids[start:start + len(texts)]
                spread = np.array([xxhash.xxh3_64_intdigest(str(i)) & 0x7FFFFFFF for i in mine], np.int64)
                sig = np.concatenate([-1 - ((np.array(sizes, np.int64) << 31) | spread)] + parts)
                counts = [len(p) for p in parts]
                id_out = pa.concat_arrays([pa.array(mine, pa.int64()), pa.array(np.repeat(np.array(own, np.int64), counts))])
                rep_out = pa.concat_arrays([pa.array(reps, pa.int64()), pa.nulls(int(sum(counts)), pa.int64())])
                sketch_out = pa.concat_arrays([pa.array(sketches, pa.binary()), pa.nulls(int(sum(counts)), pa.binary())])
                yield pa.RecordBatch.from_arrays([pa.array(sig), id_out, rep_out, sketch_out], ["sig", "id", "rep", "sketch"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "sig long, id long, rep long, sketch binary")


def _among(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose id in this column is named in the one column of ``ids``, without a shuffle of the rows.

    The ids are kept as bitmaps, 4 KB for 32,768 neighbouring ids; Spark broadcasts them while they are
    small and joins by bucket beyond its limit.
    """
    named = ids.toDF("i").groupBy(F.bitmap_bucket_number("i").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("i")).alias("bits"))
    place = f"bitmap_bit_position({column})"
    byte = f"cast(conv(hex(substring(bits, cast(floor({place} / 8) as int) + 1, 1)), 16, 10) as int)"
    return (rows.withColumn("bucket", F.bitmap_bucket_number(column)).join(written(named, "ngram-ids"), "bucket")
            .where(F.expr(f"shiftright({byte}, cast({place} % 8 as int)) & 1 = 1")).select(*rows.columns))


def _texts_of(docs: DataFrame, ids: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, text) of the documents named in the one column of ``ids``."""
    return _among(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")), "id", ids)


def _verify(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int, n: int) -> DataFrame:
    """The pairs (a, b) with ``linked``: 100 x intersection >= percent x union, on the whole texts."""
    right = _texts_of(docs, pairs.select("b"), doc_id, text).toDF("b", "text_b")
    left = _texts_of(docs, pairs.select("a"), doc_id, text).toDF("a", "text_a")
    both = pairs.join(right, "b").join(left, "a")

    def run(batches):
        known, known_set = None, None
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            hub_texts = batch.column(2)
            linked = np.zeros(len(a), bool)
            for start, stop, texts in text_blocks(batch, "text_b"):
                for k, right in zip(range(start, stop), shingle_sets(texts, n)):
                    hub = hub_texts[k].as_py()
                    if hub != known:
                        known, known_set = hub, shingle_sets([hub], n)[0]
                    small, large = sorted((known_set, right), key=len)
                    if 100 * len(small) < percent * len(large) or not len(small):
                        continue
                    at = np.searchsorted(large, small)
                    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                    linked[k] = 100 * common >= percent * (len(small) + len(large) - common)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(linked)], ["a", "b", "linked"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean")


def link_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75,
                    n: int = WORDS) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable by links).

    A null or empty text has no shingle and is linked with nothing. Rows that
    repeat an id count as one document that has all their texts' links. A null
    id stays alone, with a null component.
    """
    published = _publish(docs, doc_id, text, percent, n, common_shingles(docs, text, n))
    by_part = Window.partitionBy("sig").orderBy("id")
    grouped = published.withColumns({
        "hub": F.first("id").over(by_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    # kept: the size rows, and for parts that several documents published all but the hub's own row
    found = written(grouped.where("sig < 0 or hub <> id").select("sig", "id", "rep", "sketch", "hub"), "ngram-parts")
    sizes = found.where("sig < 0").select("id", "rep", F.expr("shiftright(-1 - sig, 31)").alias("n"), "sketch")
    equal = sizes.where("id <> rep").select("rep", "id").distinct().toDF("a", "b")

    shared = found.where("sig >= 0").select("sig", "id", "hub")
    star = written(shared.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "ngram-pairs")
    near = written(_allowed(star, sizes.select("id", "n", "sketch"), percent), "ngram-pairs")
    linked = written(_verify(near, docs, doc_id, text, percent, n).where("linked").select("a", "b").distinct(), "ngram-star")
    links = linked.unionByName(equal)
    first = written(component_ids(links), "ngram-first")

    # parts whose hub failed with a member: compare their members across components
    failed = star.join(linked, ["a", "b"], "left_anti").toDF("hub", "id")
    suspect = _among(shared, "hub", failed.select("hub"))
    odd = _among(suspect, "id", failed.select("id")).join(failed, ["hub", "id"], "left_semi").select("sig").distinct()
    placed = written(suspect.select("sig", "id").join(odd, "sig", "left_semi").distinct()
                     .join(first.withColumnRenamed("component", "c"), "id", "left")
                     .select("sig", "id", F.coalesce("c", "id").alias("c")), "ngram-odd")
    # groups of several components, and of those with the same members one
    several = (placed.groupBy("sig").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.count("*").alias("k"),
                                         F.bit_xor(F.xxhash64("id")).alias("x1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("x2"))
               .where("c1 <> c2").groupBy("k", "x1", "x2").agg(F.min("sig").alias("sig")).select("sig"))
    placed = written(placed.join(several, "sig", "left_semi"), "ngram-odd")
    held = sizes.join(placed.select("id").distinct(), "id", "left_semi").select("id", "n", "sketch").dropDuplicates(["id", "sketch"])
    cross = written(_cross_pairs(placed, held, percent).where("a <> b").join(star, ["a", "b"], "left_anti"), "ngram-pairs")
    more = written(_verify(cross, docs, doc_id, text, percent, n).where("linked").select("a", "b"), "ngram-cross")
    final = component_ids(links.unionByName(more)) if more.take(1) else first
    return (sizes.join(final, "id", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id")))


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75,
                         n: int = WORDS) -> DataFrame:
    """The input rows whose id is its component's smallest, with all their columns; rows with a null id stay.

    Of rows that repeat an id, all stay.
    """
    dropped = (link_components(docs, doc_id, text, percent, n).where("doc_id <> component_id")
               .select(F.col("doc_id").alias(doc_id)).distinct())
    return docs.join(dropped, doc_id, "left_anti").select(*docs.columns)
