"""Top-k against all products, with ties, repeated rows, odd vectors and every way of pruning."""

import math

import numpy as np
import pytest

from docfold.llm import topk
from docfold.llm.common import ready

SCHEMA = "vec_id long, embedding array<float>, score int"


def whole(v):
    return [math.floor(1024 * float(np.float32(x))) for x in v]


def brute(rows, queries, k):
    fine = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    have = [(i, whole(v)) for i, v in rows if i is not None and fine(v)]
    out = []
    for q, v in queries:
        if q is None or not fine(v):
            continue
        w = whole(v)
        cut = lambda x: max(-(2**63), min(2**63 - 1, x))
        scores = [(cut(sum(a * b for a, b in zip(w, c, strict=False))), i) for i, c in have if i != q]
        scores.sort(key=lambda s: (-s[0], s[1]))
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, queries, **options):
    ready(spark)
    left = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(3)
    right = spark.createDataFrame([(*r, 0) for r in queries], SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(left, right, **options).collect())


def clustered(seed, n, width, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, width))
    x = centres[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, width))
    x *= rng.lognormal(0, 0.5, (n, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("spread", [0.05, 0.4, 3.0])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "SEED_ROWS", 40)
    rows = clustered(1, 700, 12, spread)
    queries = rows[::25]
    assert run(spark, rows, queries, query_block=10) == brute(rows, queries, 10)


def test_ties_and_odd_vectors(spark):
    rows = [(i, [0.5, 0.25]) for i in range(30)] + [(30 + i, [-0.5, 0.1 * i]) for i in range(6)]
    rows += [(100, None), (101, [None, 1.0]), (102, [float("nan"), 1.0]), (103, [float("inf"), 0.0])]
    rows += [(104, []), (105, [0.0, 0.0]), (106, [9.0]), (107, [0.1, 0.2, 0.3]), (None, [5.0, 5.0])]
    rows += [rows[3], rows[3], (4, [7.0, 7.0])]
    queries = [r for r in rows if r[0] is not None and r[0] % 2 == 0]
    assert run(spark, rows, queries) == brute(rows, queries, 10)


def test_huge_components_are_exact(spark):
    rows = [(i, [float(10 ** (i % 14)), -1.0 * i, 3e13]) for i in range(25)]
    assert run(spark, rows, rows[:4], k=5) == brute(rows, rows[:4], 5)
    rows = [(i, [1e6 + i, -1e6 + 3 * i, 0.5]) for i in range(25)]
    assert run(spark, rows, rows[:4], k=5) == brute(rows, rows[:4], 5)


def test_few_rows(spark):
    rows = [(0, [1.0]), (1, [2.0])]
    assert run(spark, rows, rows) == [(0, 1, 1, 2 * 1024 * 1024), (1, 1, 0, 2 * 1024 * 1024)]
    assert run(spark, rows, []) == []
    assert run(spark, [], rows) == []
    assert run(spark, [], []) == []
