"""Exact quantiles over ranges of values."""

import math
import random

from docfold.operators import metrics

QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def summary(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x bigint").repartition(5)
    return metrics.ranked_summary(frame, "x", QUANTILES).first().asDict()


def test_quantiles_are_exact_ranks(spark):
    rng = random.Random(4)
    for values in ([rng.randrange(-500, 500) for _ in range(3000)], [7] * 40 + [9], list(range(1000)), [3]):
        ordered = sorted(values)
        want = {n: ordered[max(1, math.ceil(len(ordered) * q)) - 1] for n, q in QUANTILES.items()}
        got = summary(spark, [*values, None, None])
        assert got == {"n": len(values), "total": sum(values), "largest": ordered[-1], **want}


def test_no_values(spark):
    assert summary(spark, [None])["n"] == 0


def test_all_values_are_not_ranked_in_one_task(spark):
    """The only windows over all rows are those over one row per range."""
    frame = spark.range(100_000).withColumnRenamed("id", "x")
    plan = metrics.ranked_summary(frame, "x", QUANTILES)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in f" {line.strip(' +-:|')} "]
    assert windows and all("_s#" in w or "_p#" in w for w in windows)
