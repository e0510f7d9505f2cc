"""Language-model scores of whole texts: a word unigram base and a causal self-attention model.

Counts (words and subwords, the subwords as they are scored: ids of whole raw
texts) cover every training document and are summed by Spark. So are the transitions between the input rows of the attention model, which
give its classes and its bigram term. Its other weights are trained on every window of
every whole training text, by the tasks that read the texts: in each of ``ROUNDS`` rounds the
tasks start from the same weights, train on the round's texts, and their weights are averaged by
the number of targets (what the driver gets is a few rows of 105,000 numbers, whatever the input). Few windows are
passed over several times in one task. Texts are scored in overlapping windows, each token once.

Words are known by 64-bit hashes. The counts of the ``head`` most frequent
words go to every task (the bound of that broadcast); a text's other words meet
their counts in a join on the word.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelstat.llm.attention import CLASSES, OWN_ROWS, RATE, STRIDE, WINDOW, CausalAttention, cluster_rows, input_rows, layout, sequence_scores
from reelstat.llm.common import flat, hashes, int_arrays, mix, most_frequent, text_blocks, written
from reelstat.llm.tokens import VOCABULARY, encode, encoding
from reelstat.llm.wordhash import word_hashes

#: Up to so many training windows one task passes over all of them, for at least so many steps.
FEW_WINDOWS, STEPS = 128_000, 2_000
#: Of more windows each is trained on once, in one of so many rounds, in steps of so many windows out of a slice of neighbours.
ROUNDS, BATCH, SLICE = 8, 128, 8192
#: The columns with the ids of a text, its hash and its bytes' number, beside the user's own.
IDS, DEAL, SIZE = "_lm_ids", "_lm_deal", "_lm_size"
#: Different counts, and pairs of rows, that a task gathers before it adds them up.
GATHERED = 1_000_000
#: Weight, in transitions, of the overall shares of the classes in those after an input row.
PRIOR = 5
#: The key of the end-of-text token among word keys.
END_KEY = 0x5EED0F0E0D0C0B0A


def word_keys(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all words with A-Z as a-z, words per text)."""
    data = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    found, _, starts, _ = word_hashes(b"\n".join(data))
    edges = np.cumsum([0, *(len(d) + 1 for d in data)])
    return mix(found[0] ^ mix(found[1])).view(np.int64), np.diff(np.searchsorted(starts, edges))


def _id_type(vocabulary: str):
    """What an id is written as: two bytes where they hold every id."""
    return np.uint16 if encoding(vocabulary).n_vocab <= 1 << 16 else np.uint32


def encoded(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, doc_id: str = "doc_id") -> DataFrame:
    """The rows with the ids of their whole texts in a column ``IDS`` (bytes, see ``_id_type``: an array of numbers takes the JVM many times
    the memory and time) and the hash by which ``train`` deals them in ``DEAL``, written, so that each text is encoded once. ``SIZE``: the bytes of the text."""
    def run(batches):
        for batch in batches:
            for start, stop, texts in text_blocks(batch, text):
                ids = pa.array([encode(t, vocabulary).astype(_id_type(vocabulary)).tobytes() for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([*[c.slice(start, stop - start) for c in batch.columns], ids], [*batch.schema.names, IDS])

    words = F.col(text).cast("string")
    rows = docs.withColumns({DEAL: F.xxhash64(F.col(doc_id).cast("string"), words), SIZE: F.coalesce(F.octet_length(words), F.lit(0))})
    return written(rows.mapInArrow(run, StructType([*rows.schema.fields, *StructType.fromDDL(f"{IDS} binary").fields])), "lm-ids")


def _blocks(batches, vocabulary: str):
    """(batch, from, to, texts, ids of each) by blocks of texts; ids come from the column ``IDS`` where there is one, and without
    a column of texts the ids' bytes stand for them, in the same blocks."""
    for batch in batches:
        names, kind = batch.schema.names, _id_type(vocabulary)
        blocks = text_blocks(batch, "text") if "text" in names else text_blocks(batch, IDS, sizes=batch.column(names.index(SIZE)).to_numpy())
        for start, stop, texts in blocks:
            if IDS not in names:
                yield batch, start, stop, texts, [encode(t, vocabulary) for t in texts]
            else:
                data = batch.column(names.index(IDS)).slice(start, stop - start).to_pylist() if "text" in names else texts
                yield batch, start, stop, texts, [np.frombuffer(d, kind) for d in data]


def _read(docs: DataFrame, text: str, *others, words: bool = True) -> DataFrame:
    """The columns that ``_blocks`` needs, and others; texts only for their ``words`` or where there are no ids."""
    has_ids = IDS in docs.columns
    whole = [F.col(text).cast("string").alias("text")] if words or not has_ids else [SIZE]
    return docs.select(*whole, *others, *([IDS] if has_ids else []))


def corpus_counts(training: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(sub, key, c): counts of words (sub false) and of subword ids (sub true) over all whole texts, as they are
    scored; each text has one end among the words and one among the ids.
    """

    def run(batches):
        end = encoding(vocabulary).n_vocab
        subwords = np.zeros(end + 1, np.int64)

        def word_rows():
            values, place = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(values), bool)), pa.array(values), pa.array(counts)], ["sub", "key", "c"])

        held, size = [], 0
        for _, _, _, texts, ids in _blocks(batches, vocabulary):
            subwords += np.bincount(flat(ids, np.int64), minlength=end + 1)
            subwords[end] += len(texts)
            codes, values = pd.factorize(word_keys(texts)[0])
            held.append((np.append(values, END_KEY), np.append(np.bincount(codes, minlength=len(values)), len(texts))))
            size += len(values)
            if size >= GATHERED:
                yield word_rows()
                held, size = [], 0
        if held:
            yield word_rows()
        used = np.flatnonzero(subwords)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(used), bool)), pa.array(used), pa.array(subwords[used])], ["sub", "key", "c"])

    rows = _read(training, text).mapInArrow(run, "sub boolean, key long, c long")
    return rows.groupBy("sub", "key").agg(F.sum("c").alias("c"))


def context_rows(training: DataFrame, row: np.ndarray, end: int, share: float, doc_id: str = "doc_id", text: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """(pair, c, window) over all whole training texts: how often an input row is followed by a target's row (pair =
    input row x (OWN_ROWS + 1) + target's row; a task adds up its own, at most their product), and each window whose
    hash of document id and place falls under ``share``: the id before it (-1: none) and its targets (-1: past the end).
    """
    places = np.arange(-1, WINDOW)

    def run(batches):
        table = np.zeros((OWN_ROWS + 2) * (OWN_ROWS + 1), np.int64)
        for batch, start, stop, texts, ids in _blocks(batches, vocabulary):
            sizes = np.array([len(x) + 1 for x in ids])
            first = np.cumsum(sizes) - sizes
            targets = np.insert(flat(ids, np.int64).astype(np.int64), np.cumsum(sizes - 1), end)
            rows = row[targets]
            before = np.append(OWN_ROWS + 1, rows[:-1])
            before[first] = OWN_ROWS + 1
            pairs, counts = np.unique(before.astype(np.int32) * np.int32(OWN_ROWS + 1) + rows.astype(np.int32), return_counts=True)
            table[pairs] += counts
            each = np.maximum(-(-(sizes - WINDOW + STRIDE) // STRIDE), 1)
            owner = np.repeat(np.arange(len(sizes)), each)
            local = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
            names = hashes([str(x).encode() for x in batch.column(batch.schema.get_field_index("id")).slice(start, stop - start).to_pylist()])
            chosen = np.flatnonzero(mix(names[owner] ^ mix(local.astype(np.uint64) + np.uint64(1))) < np.uint64(min(share, 1.0) * (2 ** 64 - 2 ** 12)))
            at = (local[chosen] * STRIDE)[:, None] + places
            inside = (at >= 0) & (at < sizes[owner[chosen]][:, None])
            windows = np.where(inside, targets[np.where(inside, first[owner[chosen]][:, None] + at, 0)], -1).astype(np.int32)
            none = pa.nulls(len(windows), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, int_arrays(windows.ravel(), np.full(len(windows), WINDOW + 1))], ["pair", "c", "window"])
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(table[used]), pa.nulls(len(used), pa.list_(pa.int32()))], ["pair", "c", "window"])

    return _read(training, text, F.col(doc_id).alias("id"), words=False).mapInArrow(run, "pair long, c long, window array<int>")


class Scorer:
    """What tasks need to score texts with the model, whose weights ``train`` fits.

    ``counts``: of each id; ``pairs``: of each target's row (columns) after each input row.
    """

    def __init__(self, counts: np.ndarray, row: np.ndarray, pairs: np.ndarray, vocabulary: str = VOCABULARY):
        self.vocabulary, self.row = vocabulary, row
        self.end = len(counts) - 1
        self.kind = cluster_rows(counts, row, pairs)
        self.model = CausalAttention()
        self.trained_targets = 0
        if pairs.any():
            of_row = np.full(OWN_ROWS + 1, CLASSES - 1)
            of_row[row] = self.kind
            follow = np.stack([np.bincount(of_row, p, CLASSES) for p in pairs])
            every = (follow.sum(axis=0) + 0.1) / (follow.sum() + 0.1 * CLASSES)
            self.model.p["bigram"] = np.log((follow + PRIOR * every) / (follow.sum(axis=1, keepdims=True) + PRIOR)).astype(np.float32)
        smooth = counts + 0.01
        per_class = np.bincount(self.kind, smooth)
        self.within = (np.log(smooth) - np.log(per_class[self.kind])).astype(np.float32)

    def scores(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each sequence of ids and its end."""
        return sequence_scores(self.model, self.within, self.kind, self.row, sequences, self.end) / np.log(10)


def fit(training: DataFrame, counts: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, doc_id: str = "doc_id") -> Scorer:
    subwords = np.zeros(encoding(vocabulary).n_vocab + 1)
    for r in counts.where("sub").collect():  # at most the size of the vocabulary
        subwords[r["key"]] = r["c"]
    end, tokens = len(subwords) - 1, subwords.sum()
    row = input_rows(subwords, end)
    context = context_rows(training, row, end, 0, doc_id, text, vocabulary)
    found = context.where("pair is not null").groupBy("pair").agg(F.sum("c").alias("c")).toArrow()
    pairs = np.zeros((OWN_ROWS + 2) * (OWN_ROWS + 1))
    pairs[found.column("pair").to_numpy()] = found.column("c").to_numpy()
    scorer = Scorer(subwords, row, pairs.reshape(OWN_ROWS + 2, OWN_ROWS + 1), vocabulary)
    if tokens:
        train(training, scorer, int(tokens // STRIDE + subwords[end]), text, doc_id)
    return scorer


def train(training: DataFrame, scorer: Scorer, windows: int, text: str = "text", doc_id: str = "doc_id") -> None:
    """Fits the model's weights on all windows of the training texts, of which there are at most ``windows``."""
    model, kind, row, end = scorer.model, scorer.kind, scorer.row, scorer.end

    def slices(batches):
        """(inputs, classes of the targets, whether to learn them): each target is learned in one window."""
        for _, _, _, _, ids in _blocks(batches, scorer.vocabulary):
            for inputs, targets, _, scored in layout(ids, row, end, SLICE):
                yield inputs, kind[targets], scored

    def answer(targets: int):
        """A row with the targets and, times their number, the steps and the state."""
        state = targets * model.state().astype(np.float64)
        return pa.RecordBatch.from_arrays([pa.array([targets]), pa.array([targets * model.steps]), pa.array([state.tobytes()])], ["targets", "steps", "state"])

    def passes(batches):
        held = [np.concatenate(part) for part in zip(*slices(batches), strict=True)]
        if held:
            inputs, kinds, scored = (part[np.lexsort(np.hstack(held).T)] for part in held)  # whatever the order of rows
            times = model.train(inputs, kinds, scored, STEPS)
            yield answer(times * int(scored.sum()))

    def one_round(batches):
        rng, targets = np.random.default_rng(TaskContext.get().partitionId()), 0
        for inputs, kinds, scored in slices(batches):
            order = rng.permutation(len(inputs))
            for a in range(0, len(order), BATCH):
                at = order[a:a + BATCH]
                model.step(inputs[at], kinds[at], scored[at], rate)
            targets += int(scored.sum())
        if targets:
            yield answer(targets)

    def summed(batches):
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        if rows:
            targets, steps = (sum(r[i] for r in rows) for i in range(2))
            state = sum(np.frombuffer(r[2]) for r in rows)
            yield pa.RecordBatch.from_arrays([pa.array([targets]), pa.array([steps]), pa.array([state.tobytes()])], ["targets", "steps", "state"])

    def averaged(answers: DataFrame) -> None:
        # in tasks of their own: a second Python process beside the one that trains would double what a core holds
        few = math.ceil(math.sqrt(answers.rdd.getNumPartitions()))
        for parts in (few, 1) if few > 1 else ():
            answers = answers.repartition(parts).mapInArrow(summed, schema)
        for r in answers.collect():
            model.restore(np.frombuffer(r.state) / r.targets, max(round(r.steps / r.targets), 1))
            scorer.trained_targets += r.targets

    schema = "targets long, steps long, state binary"
    if windows <= FEW_WINDOWS:
        averaged(_read(training, text, words=False).coalesce(1).mapInArrow(passes, schema))
        return
    texts = training if IDS in training.columns else encoded(training, text, scorer.vocabulary, doc_id)
    for number in range(ROUNDS):
        rate = RATE * min(1, 2 * (1 - (number + 0.5) / ROUNDS))
        part = texts.where(F.pmod(DEAL, F.lit(ROUNDS)) == number)
        averaged(_read(part, text, words=False).mapInArrow(one_round, schema))


def score_texts(docs: DataFrame, counts: DataFrame, scorer: Scorer, doc_id: str = "doc_id", text: str = "text", head: int = 200_000,
                keep: dict | None = None) -> DataFrame:
    """One row per input row: doc_id, the ``keep`` columns, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is its end alone. Without training texts every count
    is 0 and the model is untrained; scores stay finite. Repeated rows repeat.
    """
    words = counts.where("not sub").select("key", "c")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    scale = float(np.log10(total["n"] + 0.1 * (total["v"] + 1)))
    head_keys, head_counts = most_frequent(words, "key", "c", head)
    names = list(keep or {})

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for batch, start, stop, texts, ids in _blocks(batches, scorer.vocabulary):
            keys, sizes = word_keys(texts)
            ends = np.cumsum(sizes)
            keys = np.insert(keys, ends, END_KEY)
            owner = np.repeat(np.arange(len(texts)), sizes + 1)
            inverse, values = pd.factorize(keys)
            at = np.minimum(np.searchsorted(head_keys, values), max(len(head_keys) - 1, 0))
            is_head = head_keys[at] == values if len(head_keys) else np.zeros(len(values), bool)
            log_count = np.where(is_head, np.log10(np.where(is_head, head_counts[at] if len(head_keys) else 0, 0) + 0.1), 0)
            known = is_head[inverse]
            tail = ~known
            tail_sizes = np.bincount(owner[tail], minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + len(texts))), pa.array(sizes + 1),
                 pa.array(np.bincount(owner, known, len(texts)).astype(np.int64)),
                 pa.array(np.bincount(owner, log_count[inverse], len(texts))), pa.array(scorer.scores(ids)),
                 int_arrays(keys[tail], tail_sizes)] +
                [batch.column(batch.schema.get_field_index(c)).slice(start, stop - start) for c in ["doc_id", *names]],
                ["row", "n_tokens", "n_head", "head_log", "score", "tail", "doc_id", *names])
            number += len(texts)

    read = _read(docs, text, F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in (keep or {}).items()])
    kept = ", ".join(f"{n} {t}" for n, t in read.dtypes if n not in ("text", IDS))
    scored = written(read.mapInArrow(run, f"row long, n_tokens long, n_head long, head_log double, score double, tail array<long>, {kept}"), "lm-scored")
    rare = scored.select("row", F.explode("tail").alias("key")).groupBy("row", "key").agg(F.count("*").alias("k"))
    rare = (rare.join(words, "key", "left").withColumn("c", F.coalesce("c", F.lit(0))).groupBy("row")
            .agg(F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("tail_known"),
                 F.sum(F.col("k") * F.log10(F.col("c") + F.lit(0.1))).alias("tail_log")))
    base = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(scale)
    return scored.join(rare, "row", "left").select(
        "doc_id", *names, "n_tokens", (F.col("n_head") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(int(total["n"])).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
