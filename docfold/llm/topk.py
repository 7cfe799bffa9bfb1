"""Exact top-k by inner product, with norm buckets.

Vectors are ranged by length (norm) and written once, longest first; a task reads them in order and takes
them in buckets of similar length. Queries come in blocks of bounded size, each of which meets all
buckets. A query's threshold is a lower bound of its k-th best score: at first from the
longest vectors of the table, then from what the task has found. With it a bucket is skipped (no
vector in it is long enough), or pruned in one of two ways, chosen by the cosine that the
longest vector of the bucket would need: under ``COORDINATE_FROM`` by length, otherwise
by coordinates: for a query's largest coordinates, only vectors whose own lie in the range which that
cosine leaves. All that is left is verified by exact products.

Components are floor(scale * x). Vectors that are null or hold null or non-finite components take no part, nor
do rows without id. A vector with fewer components than another has zeros in the rest. Every row is a
candidate, repeated ones too; rows with the query's id are the query's own. Repeated query rows are
answered each. Scores beyond 64 bits are cut to the largest or smallest 64-bit value, and tie there. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import map_batches
from docfold.session import materialize, work_folder

K = 10
SCALE = 1024
BUCKET_ROWS = 2048
QUERY_BLOCK = 2048
SEED_ROWS = 2048
COORDINATE_FROM = 0.5
FOCUS = 4
#: Products stay exact in float64 below this bound.
_EXACT = 2.0**53
_LONG = np.iinfo(np.int64)


def scaled(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (whole numbers) and its squared norm, for rows that take part."""
    fine = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    found = rows.where("vec_id IS NOT NULL").where(F.col("embedding").isNotNull() & fine)
    found = found.select("vec_id", whole.alias("v"))
    square = lambda s, x: s + x.cast("double") * x.cast("double")
    return found.withColumn("norm2", F.aggregate("v", F.lit(0.0), square))


def matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : min(width, len(v))] = v[:width]
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    bound = np.abs(left.astype(float)).max(initial=0) * np.abs(right.astype(float)).max(initial=0)
    if bound * left.shape[1] < _EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, _LONG.min, _LONG.max).astype(np.int64)


class Queries:
    """A block of queries with what has been found for each so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        unit = vectors / np.where(self.norms, self.norms, 1)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        cosines = np.take_along_axis(unit, self.focus, axis=1)
        self.angles = np.arccos(np.clip(cosines, -1, 1))
        #: Lower bounds of the k-th best score; minus infinity if fewer than k are known.
        self.least = np.full(len(ids), -np.inf)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 2] * len(ids)

    def seed(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Thresholds from some of the candidates."""
        scores = products(self.vectors, vectors).astype(float)
        scores[self.ids[:, None] == ids] = -np.inf
        if len(ids) >= self.k:
            self.least = np.partition(scores, len(ids) - self.k, axis=1)[:, len(ids) - self.k]

    def offer(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """Verified candidates of one query."""
        good = (scores >= self.least[q]) & (ids != self.ids[q])
        if not good.any():
            return
        scores = np.concatenate([self.best[q][0], scores[good]])
        ids = np.concatenate([self.best[q][1], ids[good]])
        order = np.lexsort((ids, -scores.astype(object) if scores.min() == _LONG.min else -scores))
        order = order[: self.k]
        self.best[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[q] = max(self.least[q], float(self.best[q][0][-1]))

    def search(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        """Offer a bucket, longest vector first, to all queries it may matter to."""
        reach = self.norms * norms[0]
        # A hair of slack keeps rounding of square roots from losing a tie.
        near = np.flatnonzero(reach * (1 + 1e-9) >= self.least)
        positive = near[self.least[near] > 0]
        cosine = np.zeros(len(self.ids))
        cosine[positive] = self.least[positive] / reach[positive]
        by_coordinate = cosine >= COORDINATE_FROM
        self._by_length(near[~by_coordinate[near]], ids, vectors, norms)
        columns = None
        for q in near[by_coordinate[near]]:
            if columns is None:
                columns = (vectors / np.where(norms, norms, 1)[:, None]).T.copy()
            width = np.arccos(min(1.0, cosine[q]))
            low = np.cos(np.minimum(np.pi, self.angles[q] + width)) - 1e-9
            high = np.cos(np.maximum(0, self.angles[q] - width)) + 1e-9
            left = np.flatnonzero(norms * self.norms[q] * (1 + 1e-9) >= self.least[q])
            for f, a, b in zip(self.focus[q], low, high, strict=True):
                own = columns[f, left]
                left = left[(own >= a) & (own <= b)]
            if len(left):
                self.offer(q, ids[left], products(self.vectors[q : q + 1], vectors[left])[0])

    def _by_length(
        self, chosen: np.ndarray, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray
    ) -> None:
        if not len(chosen):
            return
        needed = self.least[chosen] / np.where(self.norms[chosen], self.norms[chosen], 1)
        # Norms fall, so what is long enough is a prefix.
        ends = np.searchsorted(-norms * (1 + 1e-9), -needed, side="right")
        ends = np.where(self.least[chosen] > 0, ends, len(ids))
        scores = products(self.vectors[chosen], vectors[: ends.max()])
        for q, end, row in zip(chosen, ends, scores, strict=True):
            self.offer(q, ids[:end], row[:end])


FOUND = T.StructType(
    [
        T.StructField("query", T.IntegerType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)


def _answers(buckets: DataFrame, block: list, seeds: list, width: int, k: int) -> DataFrame:
    """The k best candidates of every query of a block."""
    queries = Queries(np.array([r.vec_id for r in block]), matrix([r.v for r in block], width), k)
    queries.seed(np.array([r.vec_id for r in seeds]), matrix([r.v for r in seeds], width))
    shared = buckets.sparkSession.sparkContext.broadcast(queries)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = shared.value
        state = Queries(own.ids, own.vectors, own.k)
        state.least = own.least.copy()
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BUCKET_ROWS:
                _bucket(state, held, width)
                held, rows = [], 0
        if rows:
            _bucket(state, held, width)
        for q, (scores, ids) in enumerate(state.best):
            if len(ids):
                yield {
                    "query": [q] * len(ids),
                    "query_id": [int(state.ids[q])] * len(ids),
                    "vec_id": ids,
                    "score": scores,
                }

    found = map_batches(buckets, step, FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _bucket(state: Queries, held: list[pa.RecordBatch], width: int) -> None:
    ids = np.concatenate([b.column("vec_id").to_numpy() for b in held])
    vectors = matrix([v for b in held for v in b.column("v").to_pylist()], width)
    norms = np.sqrt(np.concatenate([b.column("norm2").to_numpy() for b in held]))
    order = np.argsort(-norms, kind="stable")
    state.search(ids[order], vectors[order], norms[order])


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = K,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for each row of ``queries``."""
    spark = rows.sparkSession
    ranged = scaled(rows, scale).repartitionByRange(F.desc("norm2"), "vec_id")
    buckets = materialize(ranged.sortWithinPartitions(F.desc("norm2"), "vec_id"), "topk-buckets")
    width = buckets.agg(F.max(F.size("v"))).first()[0] or 0
    asked = scaled(queries, scale)
    width = max(width, asked.agg(F.max(F.size("v"))).first()[0] or 0)
    # Any candidates give valid thresholds; long ones give good ones.
    share = max(0.0, 1 - SEED_ROWS / max(1, buckets.count()))
    long = buckets.agg(F.percentile_approx("norm2", share)).first()[0] or 0.0
    seeds = buckets.where(F.col("norm2") >= long).limit(SEED_ROWS).collect()
    folder = work_folder(spark, "topk")
    block: list = []
    for row in asked.toLocalIterator():
        block.append(row)
        if len(block) == query_block:
            _answers(buckets, block, seeds, width, k).write.mode("append").parquet(folder)
            block = []
    _answers(buckets, block, seeds, width, k).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)
