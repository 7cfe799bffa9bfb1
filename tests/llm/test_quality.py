"""The discriminant against its textbook formula, held-out accuracy, odd rows."""

import math
import os
import zlib

import numpy as np
import pytest

from docfold.llm import quality
from docfold.llm.common import ready, table

SF = "/root/testdata/sf0.01"


def auc(scores, labels):
    good = [s for s, y in zip(scores, labels, strict=True) if y]
    bad = [s for s, y in zip(scores, labels, strict=True) if not y]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    return wins / (len(good) * len(bad))


def brute_model(rows, shrinkage, least):
    """Log densities by determinant and inverse, from numpy's own covariances."""
    parts = []
    own = {k: np.array([v for v, y in rows if y == k]) for k in (0, 1)}
    pooled = sum(len(v) * np.cov(v.T, bias=True) for v in own.values()) / len(rows)
    for k in (0, 1):
        cov = (1 - shrinkage) * np.cov(own[k].T, bias=True) + shrinkage * np.diag(np.diag(pooled))
        cov += least * np.eye(len(quality.NAMES))
        parts.append((len(own[k]) / len(rows), own[k].mean(axis=0), cov))

    def score(v):
        logs = [
            math.log(p) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (v - m) @ np.linalg.inv(c) @ (v - m)
            for p, m, c in parts
        ]
        return 1 / (1 + math.exp(min(500, logs[0] - logs[1])))

    return score


def brute_choice(docs, labels):
    """The regularisation that is best over inner folds of what is learned from, and the scorer it gives."""
    x = {i: np.array(quality.statistics(None if t is None else t.encode())) for i, t in docs}
    train = {i: y for i, y in labels if zlib.crc32(str(i).encode()) % 5}
    fold = {i: zlib.crc32(f"inner {i}".encode()) % 4 for i in train}
    losses = []
    for choice in quality.CHOICES:
        loss = 0
        for f in range(4):
            score = brute_model([(x[i], y) for i, y in train.items() if fold[i] != f], *choice)
            loss -= sum(
                math.log(max(1e-9, score(x[i]) if y else 1 - score(x[i]))) for i, y in train.items() if fold[i] == f
            )
        losses.append(round(loss / len(train), 6))
    best = quality.CHOICES[losses.index(min(losses))]
    return best, brute_model([(x[i], y) for i, y in train.items()], *best)


def brute_scores(docs, labels):
    _, score = brute_choice(docs, labels)
    return {i: score(np.array(quality.statistics(None if t is None else t.encode()))) for i, t in docs}


def made():
    docs, labels = [], []
    for i in range(120):
        good = i % 3 > 0
        body = [f"w{(i * j) % 89}" for j in range(3 + i)] if good else ["SPAM!!", "$$$"] * (2 + i % 7)
        docs.append((i, " ".join(body)))
        labels.append((i, int(good)))
    return docs, labels


def test_equals_the_formula(spark):
    docs, labels = made()
    docs += [(500, None), (501, ""), (502, "x" * 100_000)]
    left = ready(spark).createDataFrame([(*d, 9.0) for d in docs], "doc_id long, text string, score double")
    right = spark.createDataFrame([(*y, None) for y in labels], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality(left, right).collect()}
    want = brute_scores(docs, labels)
    for i, score in want.items():
        assert got[i].score == pytest.approx(score, abs=1e-6)
        assert got[i].predicted == int(got[i].score >= 0.3)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert got[500].score == got[501].score


def test_regularisation_is_chosen_on_inner_folds(spark):
    docs, labels = made()
    noisy = [(i, y if i % 7 else 1 - y) for i, y in labels]
    best, score = brute_choice(docs, noisy)
    assert best != quality.CHOICES[0]  # not merely the first of equals
    left = ready(spark).createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(noisy, "doc_id long, quality int")
    for r in quality.quality(left, right).collect():
        assert r.score == pytest.approx(score(np.array(quality.statistics(docs[r.doc_id][1].encode()))), abs=1e-6)
    fixed = {r.doc_id: r.score for r in quality.quality(left, right, quality.CHOICES[0]).collect()}
    assert any(abs(fixed[i] - score(np.array(quality.statistics(t.encode())))) > 1e-3 for i, t in docs)


def test_held_out_labels_change_nothing(spark):
    docs, labels = made()
    left = spark.createDataFrame([*docs, (3, docs[3][1]), (None, "no id")], "doc_id long, text string")
    flipped = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, y in labels]
    extra = [(None, 0), (7, None), labels[8]]
    schema = "doc_id long, quality int"
    runs = [
        sorted(quality.quality(left, spark.createDataFrame(rows, schema)).collect(), key=str)
        for rows in (labels, flipped + extra)
    ]
    assert runs[0] == runs[1]
    assert len(runs[0]) == len(docs) + 2


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1), (2, 1)]])
def test_a_missing_class(spark, labels):
    left = spark.createDataFrame([(0, "a"), (1, None)], "doc_id long, text string")
    right = spark.createDataFrame(labels, "doc_id long, quality int")
    scores = {r.score for r in quality.quality(left, right).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.quality(empty, right).count() == 0


def test_keep_good_agrees(spark):
    docs, labels = made()
    left = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, label string")
    right = spark.createDataFrame(labels, "doc_id long, quality int")
    good = {r.doc_id for r in quality.quality(left, right).collect() if r.predicted}
    kept = quality.keep_good(left, right)
    assert kept.columns == left.columns
    assert {r.doc_id for r in kept.collect()} == good


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy(spark):
    labels = table(spark, SF, "labels")
    rows = quality.quality(table(spark, SF, "documents"), labels).join(labels, "doc_id")
    rows = rows.where("held_out").collect()
    assert auc([r.score for r in rows], [r.quality for r in rows]) >= 0.95
    clean = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in clean) >= 0.97 * len(clean)
