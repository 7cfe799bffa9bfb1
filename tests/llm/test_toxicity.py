"""Trees and calibration against plain versions, held-out accuracy, odd rows."""

import os
import random
import zlib

import numpy as np
import pytest

from docfold.llm import boosting, toxicity
from docfold.llm.common import ready, table

SF = "/root/testdata/sf0.1"


def walk(model, row):
    """A tree read one node at a time."""
    out = model.start
    for features, thresholds, leaves in zip(model.features, model.thresholds, model.leaves, strict=True):
        node = 0
        while node < len(features):
            node = 2 * node + (2 if row[features[node]] > thresholds[node] else 1)
        out += leaves[node - len(features)]
    return out


def test_boosting_learns_and_reads_alike():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > -0.1)).astype(float)
    model = boosting.boost(x, y)
    margin = model.margin(x)
    assert ((margin > 0) == (y > 0)).mean() > 0.97
    assert np.allclose(margin[:40], [walk(model, row) for row in x[:40]])


def test_first_split_is_the_best_one():
    x = np.array([[0.0, 5], [1, 4], [2, 3], [3, 2], [4, 1], [5, 9]])
    y = np.array([0, 0, 0, 1, 1, 1.0])
    model = boosting.boost(x, y, trees=1, depth=1)
    assert model.features[0, 0] == 0 and 2 <= model.thresholds[0, 0] < 3


def test_calibration_is_a_rising_fit():
    rng = np.random.default_rng(1)
    margin = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-3 * margin))).astype(float)
    curve = boosting.calibrate(margin, y)
    grid = curve.apply(np.linspace(-5, 5, 200))
    assert (np.diff(grid) >= 0).all() and 0 <= grid.min() and grid.max() <= 1
    assert abs(curve.apply(margin).mean() - y.mean()) < 0.05


def test_nothing_to_learn():
    model = boosting.boost(np.zeros((0, 3)), np.zeros(0))
    curve = boosting.calibrate(np.zeros(0), np.zeros(0))
    assert np.allclose(curve.apply(model.margin(np.ones((2, 3)))), 0.5)


@pytest.mark.parametrize(
    "token, word, hidden",
    [("idiot", "idiot", False), ("id1ot!", "idiot", True), ("i.d.i.o.t", "idiot", True),
     ("loooser", "loser", True), ("42", "az", False), ("", "", False), ("über,", "über", False)],
)
def test_folding(token, word, hidden):
    got = toxicity.folded(token)
    assert got[1] == hidden and (not word.isalpha() or token == "42" or got[0] == word)


def made():
    pick = random.Random(2)
    docs, labels = [], []
    for i in range(600):
        words = [f"{pick.choice('abcdefgh')}ora{pick.choice('xyzwv')}{pick.choice('mnop')}" for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            words[5], words[20] = pick.choice(["grubnik", "grubniker", "vlost"]), "you"
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_odd_rows_and_held_out_labels(spark):
    docs, labels = made()
    odd = [(900, None), (901, ""), (None, "grubnik"), (3, docs[3][1]), (902, "grubnik " * 40_000)]
    left = ready(spark).createDataFrame([(*d, 0.5) for d in docs + odd], "doc_id long, text string, score double")
    flipped = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, y in labels]
    runs = []
    for rows in (labels, flipped + [(None, 1), (7, None), labels[8]]):
        right = spark.createDataFrame(rows, "doc_id long, toxic int")
        runs.append(sorted(toxicity.toxicity(left, right).collect(), key=str))
    assert runs[0] == runs[1] and len(runs[0]) == len(docs) + len(odd)
    got = {r.doc_id: r for r in runs[0]}
    assert got[900].score == got[901].score
    assert got[902].predicted == 1
    held = [(got[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held)
    assert np.mean([r.predicted == y for r, y in held]) > 0.95


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1)]])
def test_too_few_labels(spark, labels):
    left = spark.createDataFrame([(0, "a b"), (1, None)], "doc_id long, text string")
    right = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(left, right).collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.toxicity(empty, right).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy(spark):
    labels = table(spark, SF, "labels").where("toxic IS NOT NULL")
    rows = toxicity.toxicity(table(spark, SF, "documents"), labels).join(labels, "doc_id")
    rows = rows.where("held_out").toPandas()
    bad, clean = rows[rows.toxic == 1].score.values, rows[rows.toxic == 0].score.values
    wins = (bad[:, None] > clean).mean() + 0.5 * (bad[:, None] == clean).mean()
    assert wins >= 0.97
    assert (bad >= 0.5).mean() >= 0.85 and (clean >= 0.5).mean() <= 0.02
