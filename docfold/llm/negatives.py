"""Hard negatives by segment summary filtering.

A vector is cut into segments; each segment's mean and deviation (the length of what is left without the mean)
are stored beside it. The inner product of two segments is their means' product times the segment's length, plus or minus
at most the product of their deviations, so the summed terms bound a score without the vectors. ``LEVELS`` halves
segments step by step: pairs that the coarse bounds leave open are bounded again by finer segments, and only
what is still open gets its exact product. Coarse summaries follow from the finest, so one set is kept.

Vectors are dealt into lanes of about ``LANE_ROWS`` rows by their place in the written table, and probes into blocks of
``BLOCK_PROBES``; every (lane, block) is a group of one job, so memory is bounded by the two and nothing goes
through the driver. The first lane is searched on its own: the worst score each probe still holds there is a
threshold for the others. The best of all lanes are merged per probe.

An anchor's positives are searched among the rows of its own label; then each (anchor, positive) searches the
other labels for scores between ``LOW`` and ``HIGH`` percent of the positive's.

Components are floor(scale * x). Rows with a null id, label or vector, or a null or non-finite component take no part.
Shorter vectors have zeros in the rest. Rows with the anchor's id are the anchor's own, neither positive nor negative; repeated
anchors are answered each, repeated rows are rows of their own. Ties go to the smaller id. Scores beyond 64 bits
are cut to the largest or smallest 64-bit value; the percentages are exact. An empty table, no anchors or no positives give no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import map_batches
from docfold.llm.topk import matrix, products
from docfold.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
#: Segments per vector, coarse to fine; each level halves or quarters those before.
LEVELS = (1, 4, 16)
LANE_ROWS = 16_384
BLOCK_PROBES = 16_384
#: Rows and probes that are compared at a time.
ROW_STEP, PROBE_STEP = 2_048, 256
#: Relative room for rounding in the bounds.
SLACK = 1e-9

_LONG = np.iinfo(np.int64)
_SUMMED = "vec_id long, label long, v array<long>, means array<double>, devs array<double>"


def _whole(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and v (whole numbers), for rows that take part."""
    fine = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    found = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return found.where(fine).select("vec_id", F.col("label").cast("long").alias("label"), whole.alias("v"))


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment; the width is a multiple of their number."""
    cut = vectors.astype(float).reshape(len(vectors), segments, -1)
    means = cut.mean(axis=2)
    return means, np.sqrt(((cut - means[:, :, None]) ** 2).sum(axis=2))


def coarser(means: np.ndarray, devs: np.ndarray, segments: int, length: int):
    """Summaries of fewer segments from those of more; ``length`` is that of a fine segment."""
    shape = (len(means), segments, -1)
    fine, spread = means.reshape(shape), devs.reshape(shape)
    wide = fine.mean(axis=2)
    parts = spread**2 + length * (fine - wide[:, :, None]) ** 2
    return wide, np.sqrt(parts.sum(axis=2))


def _summed(rows: DataFrame, width: int) -> DataFrame:
    """vec_id, label, v and the finest summaries."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            vectors = matrix(batch.column("v").to_pylist(), width)
            means, devs = summaries(vectors, LEVELS[-1])
            yield {
                "vec_id": batch.column("vec_id"),
                "label": batch.column("label"),
                "v": list(vectors),
                "means": list(means),
                "devs": list(devs),
            }

    return map_batches(rows, step, T.StructType.fromDDL(_SUMMED))


class Side:
    """Vectors of one group with their summaries at every level."""

    def __init__(self, table: pa.Table, width: int):
        stack = lambda name, n: np.asarray(
            table.column(name).combine_chunks().flatten()
        ).reshape(-1, n)
        self.ids = table.column("vec_id").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.vectors = stack("v", width)
        means, devs = stack("means", LEVELS[-1]), stack("devs", LEVELS[-1])
        self.levels = [coarser(means, devs, n, width // LEVELS[-1]) for n in LEVELS]


def search_group(probes: Side, low, high, least, rows: Side, k: int, same: bool, width: int):
    """For every probe its k best rows of the same label, or else of another one, within [low, high].

    ``least`` is a score the k-th best is known to reach. Returns probe places, ids and scores.
    """
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 2] * len(probes.ids)
    floor = np.maximum(low, least)
    for first in range(0, len(rows.ids), ROW_STEP):
        near = slice(first, first + ROW_STEP)
        for start in range(0, len(probes.ids), PROBE_STEP):
            own = slice(start, min(start + PROBE_STEP, len(probes.ids)))
            left, right, open_ = _open_pairs(probes, rows, own, near, floor, high, same, width)
            if not len(left):
                continue
            scores = products(probes.vectors[left], rows.vectors[right])
            good = open_ & (scores >= floor[left, None]) & (scores <= high[left, None])
            for i in np.flatnonzero(good.any(axis=1)):
                q, at = left[i], np.flatnonzero(good[i])
                found = np.concatenate([best[q][0], scores[i, at]])
                ids = np.concatenate([best[q][1], rows.ids[right[at]]])
                # Complement instead of minus: the smallest long has no negative.
                order = np.lexsort((ids, ~found))[:k]
                best[q] = found[order], ids[order]
                if len(order) == k:
                    floor[q] = max(floor[q], best[q][0][-1])
    counts = [len(ids) for _, ids in best]
    if not sum(counts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return (
        np.repeat(np.arange(len(best)), counts),
        np.concatenate([ids for _, ids in best]),
        np.concatenate([scores for scores, _ in best]),
    )


def _open_pairs(probes, rows, own, near, floor, high, same, width):
    """Probes, rows and the mask of their pairs that no level's bounds can decide."""
    left = np.arange(own.start, own.stop)
    right = np.arange(near.start, min(near.stop, len(rows.ids)))
    open_ = (probes.labels[left, None] == rows.labels[right]) == same
    open_ &= probes.ids[left, None] != rows.ids[right]
    for n, (means, devs), (row_means, row_devs) in zip(LEVELS, probes.levels, rows.levels, strict=True):
        middle = (width // n) * (means[left] @ row_means[right].T)
        reach = devs[left] @ row_devs[right].T
        # Room for rounding: in the order of the terms, not of their sum.
        sizes = np.abs(means[left]) @ np.abs(row_means[right]).T * (width // n) + reach
        reach += SLACK * sizes + 1e-6
        open_ &= (middle + reach >= floor[left, None]) & (middle - reach <= high[left, None])
        probe_left, row_left = open_.any(axis=1), open_.any(axis=0)
        left, right = left[probe_left], right[row_left]
        open_ = open_[probe_left][:, row_left]
        if not len(left):
            break
    return left, right, open_


def _search(probes: DataFrame, rows: DataFrame, lanes: int, blocks: int, width: int, k: int, same: bool):
    """probe, vec_id, score: the k best rows of every probe, not ordered.

    ``probes`` has probe, block, low, high and the columns of a summed row.
    """
    # Open to all: the smallest long as threshold.
    open_ = probes.withColumn("least", F.lit(int(_LONG.min)))
    first = _lanes(open_, rows.where("lane = 0"), [0], blocks, width, k, same)
    first = materialize(first, "negatives-first")
    if lanes == 1:
        return first
    worst = first.groupBy("probe").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    worst = worst.where(F.col("n") >= k).select("probe", "worst")
    known = open_.join(worst, "probe", "left")
    known = known.withColumn("least", F.coalesce("worst", "least")).drop("worst")
    rest = _lanes(known, rows.where("lane > 0"), range(1, lanes), blocks, width, k, same)
    return materialize(_best(first.union(rest), k).drop("rank"), "negatives-best")


def _lanes(probes, rows, lanes, blocks: int, width: int, k: int, same: bool) -> DataFrame:
    """The k best rows of every probe in each lane."""
    numbers = F.sequence(F.lit(lanes[0]), F.lit(lanes[-1]))
    left = probes.withColumn("lane", F.explode(numbers)).groupBy("lane", "block")
    right = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(_, own: pa.Table, met: pa.Table) -> pa.Table:
        low, high, least = (own.column(c).to_numpy() for c in ("low", "high", "least"))
        if own.num_rows and met.num_rows:
            places, ids, scores = search_group(
                Side(own, width), low, high, least, Side(met, width), k, same, width
            )
        else:
            places = ids = scores = np.empty(0, np.int64)
        numbers = own.column("probe").to_numpy()[places]
        return pa.table({"probe": numbers, "vec_id": ids, "score": scores})

    return left.cogroup(right.groupBy("lane", "block")).applyInArrow(
        meet, "probe long, vec_id long, score long"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _bound(percent: int, up: bool) -> Column:
    """percent/100 of the positive's score, rounded into the allowed side; decimals keep it exact."""
    share = F.col("positive_score").cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)")
    share = share / F.lit(100).cast("decimal(3,0)")
    return (F.ceil(share) if up else F.floor(share)).cast("long")


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lane_rows: int = LANE_ROWS,
    block_probes: int = BLOCK_PROBES,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` have vec_id, embedding and label.
    """
    taken = lambda frame: _whole(frame, scale)
    whole, asked = taken(rows), taken(anchors)
    widest = max(
        frame.agg(F.max(F.size("v"))).first()[0] or 0 for frame in (whole, asked)
    )
    width = -(-max(widest, 1) // LEVELS[-1]) * LEVELS[-1]
    place = F.monotonically_increasing_id()
    stored = materialize(_summed(whole, width).withColumn("place", place), "negatives-rows")
    lanes = max(1, -(-stored.count() // lane_rows))
    dealt = stored.withColumn("lane", F.pmod("place", F.lit(lanes)).cast("int")).drop("place")
    probes = _summed(asked, width).withColumn("probe", place)
    probes = materialize(probes, "negatives-anchors")
    n_anchors = probes.count()
    blocks = max(1, -(-n_anchors // block_probes))
    numbered = lambda frame, n: frame.withColumn(
        "block", F.pmod("probe", F.lit(n)).cast("int")
    )
    whole_range = {"low": F.lit(int(_LONG.min)), "high": F.lit(int(_LONG.max))}
    first = numbered(probes, blocks).withColumns(whole_range)
    near = _best(_search(first, dealt, lanes, blocks, width, positives, True), positives)
    near = near.select(
        F.col("probe").alias("anchor"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    pairs = near.join(probes.withColumnRenamed("probe", "anchor"), "anchor")
    pairs = pairs.withColumns({"low": _bound(LOW, True), "high": _bound(HIGH, False)})
    pairs = materialize(pairs.where("low <= high").withColumn("probe", place), "negatives-pairs")
    blocks = max(1, -(-(n_anchors * positives) // block_probes))
    second = numbered(pairs.drop("anchor", "positive_id", "positive_score"), blocks)
    far = _best(_search(second, dealt, lanes, blocks, width, negatives, False), negatives)
    far = far.select(
        "probe", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), "rank"
    )
    told = pairs.select("probe", F.col("vec_id").alias("anchor_id"), "positive_id", "positive_score")
    return far.join(told, "probe").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
