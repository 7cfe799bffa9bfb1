"""Hard negatives against all products, with ties, repeated rows, odd vectors, and many lanes and blocks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docfold.llm import negatives
from docfold.llm.common import ready

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def brute(rows, anchors):
    fine = lambda r: None not in r and all(x is not None and math.isfinite(x) for x in r[1])
    have = [(i, whole(v), label) for i, v, label in rows if fine((i, v, label))]
    cut = lambda x: max(-(2**63), min(2**63 - 1, x))
    out = []
    for a, v, label in anchors:
        if not fine((a, v, label)):
            continue
        w = whole(v)
        scores = [
            (cut(sum(x * y for x, y in zip(w, c, strict=False))), i, other == label)
            for i, c, other in have
            if i != a
        ]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for score, positive, _ in [s for s in scores if s[2]][:5]:
            found = [s for s in scores if not s[2] and 50 * score <= 100 * s[0] <= 95 * score]
            out += [(a, positive, n + 1, i, score, s) for n, (s, i, _) in enumerate(found[:3])]
    return sorted(out)


def run(spark, rows, anchors, **options):
    ready(spark)
    left = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("v", F.lit("x"))
    left = left.withColumns({"lane": F.lit(9), "probe": F.lit(None), "low": F.lit(0)})
    right = spark.createDataFrame(anchors, SCHEMA)
    found = negatives.hard_negatives(left, right, **options)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(tuple(r) for r in found.collect())


def clustered(seed, n, width, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width)) + 0.4
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, width))
    labels = rng.integers(0, 4, n)
    return [(i, [float(v) for v in row], int(c)) for i, (row, c) in enumerate(zip(x, labels, strict=True))]


@pytest.mark.parametrize("spread", [0.05, 0.5, 3.0])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "ROW_STEP", 16)
    monkeypatch.setattr(negatives, "PROBE_STEP", 4)
    rows = clustered(3, 260, 20, spread)
    found = run(spark, rows, rows[::20], lane_rows=90, block_probes=7)
    assert found == brute(rows, rows[::20])
    assert spread > 1 or found


def test_ties_and_odd_rows(spark):
    rows = [(i, [0.5, 0.25], i % 3) for i in range(30)] + [(30 + i, [0.4, 0.02 * i], i % 2) for i in range(9)]
    rows += [(100, None, 1), (101, [None, 1.0], 1), (102, [float("nan"), 1.0], 1), (103, [1.0, 0.0], None)]
    rows += [(104, [float("-inf")], 0), (105, [], 0), (106, [0.0, 0.0], 1), (107, [9.0], 2)]
    rows += [(108, [0.3, 0.2, 0.1], 0), (None, [5.0, 5.0], 1), (109, [-0.5, -0.2], 1), (110, [-0.5, -0.3], 1)]
    rows += [rows[3], rows[3], (4, [0.45, 0.25], 2), (5, [0.45, 0.2], 0)]
    anchors = [r for r in rows if r[0] is not None and r[0] % 2 == 1] + [rows[7]]
    assert run(spark, rows, anchors) == brute(rows, anchors)
    assert run(spark, rows, anchors, lane_rows=5, block_probes=3) == brute(rows, anchors)


def test_huge_components_are_exact(spark):
    rows = [(i, [1e6 + 37 * i, 2e6 - 3 * i, 0.5], i % 2) for i in range(25)]
    rows += [(50 + i, [0.7e6 + 11 * i, 1e6, 0.5], i % 2) for i in range(25)]
    assert run(spark, rows, rows[:4]) == brute(rows, rows[:4]) != []
    rows = [(i, [3e13, 1e13 * (i % 7)], i % 2) for i in range(25)]
    assert run(spark, rows, rows[:4]) == brute(rows, rows[:4])


def test_few_rows(spark):
    assert run(spark, [], []) == []
    row = (0, [1.0], 1)
    assert run(spark, [row], [row]) == []
    assert run(spark, [row], []) == []
    rows = [row, (1, [1.0], 1), (2, [0.9], 2)]
    assert run(spark, rows, [row]) == brute(rows, [row]) != []


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(0)
    x, y = (rng.integers(-300, 300, (40, 64)) + 80 for _ in range(2))
    exact, last = x.astype(float) @ y.T, None
    sides = [negatives.summaries(v, 16) for v in (x, y)]
    for n in negatives.LEVELS:
        (m, d), (p, q) = (negatives.coarser(*s, n, 4) for s in sides)
        middle, reach = (64 // n) * m @ p.T, d @ q.T
        assert (np.abs(exact - middle) <= reach * (1 + 1e-9)).all()
        assert last is None or (reach <= last * (1 + 1e-9)).all()
        last = reach
        plain = [np.sqrt(((v.reshape(40, n, -1) - v.reshape(40, n, -1).mean(2, keepdims=True)) ** 2).sum(2)) for v in (x, y)]
        assert np.allclose(d, plain[0]) and np.allclose(q, plain[1])
