"""Quality scores of whole texts by kernel ridge regression on document statistics.

Each text becomes a row of statistics (characters of several classes, words,
repetition, lines), written once for all documents. Random Fourier features of
the standardised statistics approximate a Gaussian kernel. Every partition sums
the normal equations of its labelled rows, one for each half of them; the sums
meet in Spark and are solved on the driver (a matrix of ``FEATURES`` + 1 rows).
Ridge scores become probabilities by isotonic regression on scores of the
labelled rows, each given by the solution of the half it is not in.

Everything that is summed is a whole number (features and scores are rounded to
steps), so the model does not depend on the order or the place of rows.

Bounds: to the driver come the two sums of normal equations, (FEATURES + 1)^2
numbers each, and counts of ``LEVELS`` score levels; the tasks get the solution.
The model learns from all labelled rows.

Edge cases: a null or empty text has statistics of 0 and gets a score like any
other; labels that are null or other than 0 and 1 are left out; a document with several labels counts
once for each; rows without an id have no label; repeated rows repeat; without
labelled rows, or with only one of the two labels, every score is the share of
label 1 (0.5 without any); other columns stay out.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import text_blocks, written

#: Random Fourier features.
FEATURES = 256
#: Width of the Gaussian kernel, in standard deviations of a statistic times the root of their number.
WIDTH = 1.0
#: Standardised statistics end here on both sides.
REACH = 4.0
#: Ridge penalty, per labelled row.
PENALTY = 1e-3
#: Steps of a feature's range of -1 to 1, and levels of scores in calibration.
STEPS, LEVELS = 4096, 2000
#: Parts of 1 of a stored statistic.
UNIT = 1 << 16

_SENTENCE = b".,;:!?"
_CLASS = np.full(256, 5)  # other ASCII
_CLASS[128:] = 4
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\v\f\r")):
    _CLASS[list(_chars)] = _i
_CLASS[list(_SENTENCE)] = 6
NAMES = ("log_bytes log_words mean_word long_words upper digits spaces non_ascii symbols sentence_marks strong_marks repeated_marks entropy distinct_words repeated_words "
         "repeated_pairs common_word wordless capitalised shouted log_line distinct_lines short_lines ended_lines").split()


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of ``NAMES``; shares lie between 0 and 1."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(NAMES)
    codes = np.frombuffer(data, np.uint8)
    counts = np.bincount(codes, minlength=256)
    lower, upper, digits, spaces, wide, symbols, marks = np.bincount(_CLASS, counts, 7)
    size, n = len(data), len(words)
    shares = counts[counts > 0] / size
    sizes = np.fromiter(map(len, words), np.int64, n)
    twins = (codes[1:] == codes[:-1]) & np.isin(_CLASS[codes[1:]], (5, 6))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in data.split(b"\n") if not x.isspace() and x]
    first = np.fromiter((w[0] for w in words), np.uint8, n)
    return [np.log1p(size), np.log1p(n), sizes.mean() / 10, (sizes > 15).mean(), upper / max(upper + lower, 1), digits / size, spaces / size, wide / size, symbols / size,
            marks / size, (counts[33] + counts[63]) / size, twins.mean() if size > 1 else 0.0, -(shares * np.log2(shares)).sum() / 8, len(seen) / n,
            sum(map(eq, words, words[1:])) / n, 1 - pairs / max(n - 1, 1) if n > 1 else 0.0, max(seen.values()) / n,
            np.isin(_CLASS[first], (5, 6)).mean(), (_CLASS[first] == 1).mean(), sum(map(bytes.isupper, words)) / n, np.log1p(n / len(lines)),
            len(set(lines)) / len(lines), sum(len(x) < 30 for x in lines) / len(lines), sum(x.rstrip()[-1] in _SENTENCE for x in lines) / len(lines)]


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, the ``keep`` columns, stats) of every row, written: the statistics in whole parts of ``UNIT``."""
    read = docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in (keep or {}).items()], F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for start, stop, texts in text_blocks(batch, "text"):
                rows = np.rint(np.array([statistics(t) for t in texts]) * UNIT).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(NAMES)), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([*[c.slice(start, stop - start) for c in batch.columns[:-1]], lists], [*batch.schema.names[:-1], "stats"])

    kept = ", ".join(f"`{n}` {t}" for n, t in read.dtypes[:-1])
    return written(read.mapInArrow(run, f"{kept}, stats array<int>"), "quality-stats")


def labelled(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """(stats, n, p, half), written: the rows that have labels, how many, how many of them are 1, and their half (0 or 1)."""
    one = F.col(label).cast("double")
    counts = (labels.select(F.col(doc_id).alias("doc_id"), one.alias("y")).where("y in (0, 1)")
              .groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("p")))
    rows = stats.select("doc_id", "stats").join(counts, "doc_id")
    return written(rows.select("stats", "n", "p", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")), "quality-labelled")


class Model:
    """Statistics -> score. ``solutions``: ridge weights of all labelled rows, and of those of each half."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, np.maximum(deviation, 1e-3)
        self.directions = rng.standard_normal((len(NAMES), FEATURES)) / (WIDTH * len(NAMES) ** 0.5)
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)
        self.solutions = np.zeros((3, FEATURES + 1))
        self.at, self.share = np.zeros(1), np.full(1, 0.5)

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Fourier features and a constant, as whole numbers of 1 / ``STEPS``."""
        x = np.clip((stats / UNIT - self.mean) / self.deviation, -REACH, REACH)
        return np.rint(STEPS * np.column_stack([np.cos(x @ self.directions + self.phases), np.ones(len(x))]))

    def level(self, features: np.ndarray, solution: int) -> np.ndarray:
        """Ridge scores from -0.5 to 1.5 as whole levels."""
        return np.clip(np.rint((features @ self.solutions[solution] / STEPS + 0.5) * LEVELS / 2), 0, LEVELS).astype(np.int64)

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        return np.interp(self.level(self.features(stats), 0), self.at, self.share)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def isotonic(levels: np.ndarray, n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(level, share) of the blocks of the non-decreasing least-squares fit to the shares p / n at ascending levels."""
    blocks: list[list[float]] = []
    for x, size, ones in zip(levels.tolist(), n.tolist(), p.tolist(), strict=True):
        blocks.append([x * size, size, ones])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(rows: DataFrame) -> Model:
    """The model of the labelled rows, as ``labelled`` gives them."""
    spark = rows.sparkSession
    whole = lambda c: F.sum(c.cast("decimal(38,0)"))
    parts = [F.col("stats")[i] for i in range(len(NAMES))]
    sums = rows.agg(F.sum("n").alias("n"), F.sum("p").alias("p"), *[whole(c.cast("long") * F.col("n")) for c in parts],
                    *[whole(c.cast("long") * c.cast("long") * F.col("n")) for c in parts]).first()
    total, ones = sums["n"] or 0, sums["p"] or 0
    if ones in (0, total):
        model = Model(np.zeros(len(NAMES)), np.ones(len(NAMES)))
        model.share = np.full(1, ones / total if total else 0.5)
        return model
    first, second = (np.array([float(x) for x in sums[2 + k * len(NAMES):2 + (k + 1) * len(NAMES)]]) / total for k in (0, 1))
    mean = first / UNIT
    model = Model(mean, np.sqrt(np.maximum(second / UNIT ** 2 - mean ** 2, 0)))
    size = FEATURES + 1
    above, beside = np.triu_indices(size)

    def equations(batches):
        gram, right, counts = np.zeros((2, size, size)), np.zeros((2, size)), np.zeros(2)
        for batch in batches:
            z, n, p, half = sent.value.features(_matrix(batch.column(0))), *(batch.column(i).to_numpy() for i in (1, 2, 3))
            for h in (0, 1):
                mine = half == h
                gram[h] += (z[mine] * n[mine, None]).T @ z[mine]
                right[h] += z[mine].T @ p[mine]
                counts[h] += n[mine].sum()
        for h in (0, 1):
            if counts[h]:
                values = np.concatenate([gram[h][above, beside], right[h], counts[h:h + 1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)) + h * len(values)), pa.array(values)], ["cell", "value"])

    sent = spark.sparkContext.broadcast(model)
    cells = np.zeros(2 * (len(above) + size + 1))
    found = rows.mapInArrow(equations, "cell long, value long").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    cells[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    halves = []
    for values in cells.reshape(2, -1):
        gram = np.zeros((size, size))
        gram[above, beside] = values[:len(above)]
        halves.append((gram + np.triu(gram, 1).T, values[len(above):-1], values[-1]))
    both = tuple(a + b for a, b in zip(*halves, strict=True))
    for k, (gram, right, n) in enumerate((both, *halves)):
        if n:
            model.solutions[k] = np.linalg.solve(gram / STEPS ** 2 / n + PENALTY * np.eye(size), right / STEPS / n)

    def levels(batches):
        for batch in batches:
            z, half = fitted.value.features(_matrix(batch.column(0))), batch.column(3).to_numpy()
            at = np.where(half == 0, fitted.value.level(z, 2), fitted.value.level(z, 1))  # by the solution of the other half
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1), batch.column(2)], ["level", "n", "p"])

    fitted = spark.sparkContext.broadcast(model)
    counts = rows.mapInArrow(levels, "level long, n long, p long").groupBy("level").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).toPandas().sort_values("level")
    model.at, model.share = isotonic(*(counts[c].to_numpy(np.int64) for c in ("level", "n", "p")))
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """The rows of ``measured`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from 0.5 on, else 0) in place of the statistics."""
    sent = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = sent.value.scores(_matrix(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*batch.schema.names[:-1], "score", "predicted"])

    kept = ", ".join(f"`{n}` {t}" for n, t in stats.dtypes if n != "stats")
    return stats.mapInArrow(run, f"{kept}, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                   keep: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, the ``keep`` columns, score, predicted) of every document, learnt from the labels of those where ``learn`` holds."""
    names = list(keep or {})
    stats = measured(docs, doc_id, text, (keep or {}) | {"learn": learn})
    model = fit(labelled(stats.where("learn"), labels, doc_id, label))
    return scored(stats.select("doc_id", *names, "stats"), model)
