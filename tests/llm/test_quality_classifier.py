"""The quality classifier: its model against one solved in a single piece, its accuracy on documents it has not seen."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from reelstat.llm import quality_classifier as qc

SCHEMA = "doc_id long, text string, learn boolean, stats string, score int, n int"
LABELS = "doc_id long, quality int, toxic int, n int"


def prose(rng, n):
    return " ".join(rng.choice(["Some", "plain", "words", "of", "the", "text,", "here.", "They", "go", "on."]) for _ in range(n))


def rows_of(seed, n):
    """(documents, labels): plain prose, and junk of symbols or repetition."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(5, 80))
        if not good:
            text = rng.choice([text.replace(" ", "### "), " ".join([w for w in text.split() for _ in range(6)])])
        docs.append((i, text, True, "s", 3, 4))
        labels.append((i, int(good), 0, 9))
    return docs, labels


def frames(spark, docs, labels, partitions=3):
    return spark.createDataFrame(docs, SCHEMA).repartition(partitions), spark.createDataFrame(labels, LABELS).repartition(2)


def outside():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def test_model_equals_one_solved_in_one_piece(spark):
    docs, labels = rows_of(1, 120)
    d, la = frames(spark, docs, [*labels, (5, 1 - labels[5][1], 0, 9), (6, None, 0, 9), (7, 3, 0, 9), (None, 1, 0, 9), (999, 1, 0, 9)], partitions=7)
    model = qc.fit(qc.labelled(qc.measured(d), la))
    x = np.rint(np.array([qc.statistics(t) for _, t, *_ in docs]) * qc.UNIT)
    n = np.array([2 if i == 5 else 1 for i in range(120)])
    p = np.array([1 if i == 5 else labels[i][1] for i in range(120)])
    mean = np.average(x, axis=0, weights=n) / qc.UNIT
    assert np.allclose(model.mean, mean)
    assert np.allclose(model.deviation, np.maximum(np.sqrt(np.average((x / qc.UNIT - mean) ** 2, axis=0, weights=n)), 1e-3), rtol=1e-6)
    z = model.features(x) / qc.STEPS
    weights = np.linalg.solve(z.T @ (z * n[:, None]) / n.sum() + qc.PENALTY * np.eye(qc.FEATURES + 1), z.T @ p / n.sum())
    assert np.allclose(model.solutions[0], weights, rtol=1e-6, atol=1e-9)
    again = qc.fit(qc.labelled(qc.measured(d.repartition(2)), la))
    assert (again.solutions == model.solutions).all() and (again.share == model.share).all()


def test_fourier_features_approximate_the_gaussian_kernel(monkeypatch):
    monkeypatch.setattr(qc, "FEATURES", 40_000)
    model = qc.Model(np.zeros(len(qc.NAMES)), np.ones(len(qc.NAMES)))
    x = np.random.default_rng(1).standard_normal((5, len(qc.NAMES)))
    z = model.features(x * qc.UNIT)[:, :-1] / qc.STEPS
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * qc.WIDTH ** 2 * len(qc.NAMES)))
    assert np.abs(2 * z @ z.T / 40_000 - kernel).max() < 0.03


def test_isotonic_fit():
    at, share = qc.isotonic(np.array([0, 1, 2, 3, 4]), np.array([1, 1, 2, 1, 1]), np.array([0, 1, 1, 1, 1]))
    assert share.tolist() == [0, 2 / 3, 1] and at.tolist() == [0, 5 / 3, 3.5]
    rng = np.random.default_rng(3)
    n = rng.integers(1, 5, 60)
    p = rng.binomial(n, np.linspace(0.2, 0.8, 60))
    at, share = qc.isotonic(np.arange(60), n, p)
    assert (np.diff(share) > 0).all() and (np.diff(at) > 0).all() and share[0] >= 0 and share[-1] <= 1
    # the least-squares fit is the largest of the smallest averages (max-min formula)
    mean = lambda a, b: p[a:b + 1].sum() / n[a:b + 1].sum()
    fitted = [max(min(mean(a, b) for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    assert np.allclose(sorted(set(np.round(fitted, 12))), share)


def test_unseen_documents_and_what_is_not_an_input(spark):
    docs, labels = rows_of(2, 600)
    d, la = frames(spark, docs, labels)
    found = {r["doc_id"]: r for r in qc.quality_scores(d, la, ~outside(), keep={"held_out": outside()}).collect()}
    unseen = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(found[i]["held_out"] == (i in set(unseen)) for i in range(600))
    assert np.mean([found[i]["predicted"] == labels[i][1] for i in unseen]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    # labels of held-out documents change nothing
    other = [(i, 1 - q if i in set(unseen) else q, t, n) for i, q, t, n in labels]
    again = qc.quality_scores(d, frames(spark, docs, other)[1], ~outside(), keep={"held_out": outside()}).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {i: r["score"] for i, r in found.items()}


def test_edges(spark):
    docs, labels = rows_of(3, 60)
    extra = [(100, None, True, "s", 1, 2), (101, "", True, "s", 1, 2), (102, " \n\t", True, "s", 1, 2), (None, "Some plain text.", True, "s", 1, 2),
             (103, "word " * 900_000, True, "s", 1, 2), (104, "x" * 3_000_000, True, "s", 1, 2), docs[0], docs[0]]
    d, la = frames(spark, [*docs, *extra], labels)
    rows = qc.quality_scores(d, la, ~outside(), keep={"held_out": outside()}).collect()
    assert len(rows) == len(docs) + len(extra) and rows[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    same = {i: {r["score"] for r in rows if r["doc_id"] == i} for i in (0, 100, 101, 102)}
    assert len(same[0]) == 1 and same[100] == same[101] == same[102]
    assert qc.quality_scores(d.where("false"), la, ~outside()).collect() == []


@pytest.mark.parametrize(("kept", "score"), [("quality = 1", 1.0), ("quality = 0", 0.0), ("false", 0.5)])
def test_labels_of_one_kind_or_none(spark, kept, score):
    docs, labels = rows_of(4, 20)
    d, la = frames(spark, docs, labels)
    assert {r["score"] for r in qc.quality_scores(d, la.where(kept), F.lit(True)).collect()} == {score}


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    rows = E.queries()["op11_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97
