"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

A text becomes ``NAMES``: shares of character kinds, of repeated and capital words, of line shapes.
Shares go through a square root and sizes through a logarithm, which makes both classes rounder.
Each class has a mean and a covariance, shrunk towards the pooled diagonal; a document's score is the
logistic of the difference of the two log densities, computed as Mahalanobis distances with
Cholesky factors that are computed once per model.

The sums for means and covariances come from all labelled rows, added up where the rows are. How much to shrink and
what to add to the variances is chosen among ``CHOICES`` by the log loss over inner folds of these same rows; labels
that are held out have no say in it. Very long texts are read whole; an empty table gives no rows.
Null and empty texts are the same and get a score like any other. Null labels and labels of rows that are held
out are not learned from; several labels of one id count as the largest; repeated rows of documents
count and are scored each; a null id is never learned from. If a class has no row, every
score is the smoothed share of class 1. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import map_batches, utf8
from docfold.session import materialize

THRESHOLD = 0.3
FOLDS = 5
#: Shares of the pooled diagonal, and what is added to each variance: a statistic that never varies in a class must not
#: decide alone. The more regular choice comes first and wins a tie.
CHOICES = tuple((shrinkage, least) for shrinkage in (0.4, 0.2, 0.1, 0.05, 0.02) for least in (8e-3, 2e-3, 5e-4))
INNER_FOLDS = 4
#: Mean losses are compared after rounding, so that the order of additions doesn't choose.
LOSS_DIGITS = 6

NAMES = (
    "log_words", "log_word_length", "repeated_words", "adjacent_repeats", "capital_words", "capitals",
    "digits", "stops", "pipes", "marks", "symbols", "log_line_words", "repeated_lines", "short_lines",
)
_CLASS = {
    "capitals": bytes(range(0x41, 0x5B)),
    "digits": b"0123456789",
    "stops": b".,;:'\"()-",
    "pipes": b"|",
    "marks": b"!?",
    "symbols": b"#$%&*+/<=>@[\\]^_`{}~",
}
_MEMBER = {k: np.frombuffer(v, np.uint8) for k, v in _CLASS.items()}


def statistics(text: bytes | None) -> list[float]:
    """The transformed statistics of a whole text, in the order of ``NAMES``."""
    text = text or b""
    words = text.split()
    n = max(1, len(words))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = max(1, sum(map(len, words)))
    share = {k: counts[v].sum() / solid for k, v in _MEMBER.items()}
    distinct = len(set(words))
    adjacent = sum(map(bytes.__eq__, words, words[1:]))
    capital = sum(map(bytes.isupper, words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    values = {
        "log_words": np.log1p(len(words)) / 4,
        "log_word_length": np.log1p(solid / n),
        "repeated_words": 1 - distinct / n,
        "adjacent_repeats": np.sqrt(adjacent / n),
        "capital_words": np.sqrt(capital / n),
        **{k: np.sqrt(v) for k, v in share.items()},
        "log_line_words": np.log1p(len(words) / m) / 4,
        "repeated_lines": np.sqrt(1 - len(set(lines)) / m) if lines else 0.0,
        "short_lines": np.sqrt(sum(len(x) < 20 for x in lines) / m),
    }
    return [float(values[k]) for k in NAMES]


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows no label is learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


@dataclass
class Model:
    """Per class the log prior, mean and inverse Cholesky factor; or one score for all."""

    parts: list[tuple[float, np.ndarray, np.ndarray]]
    constant: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.parts:
            return np.full(len(x), self.constant)
        logs = []
        for prior, mean, factor in self.parts:
            z = (x - mean) @ factor.T
            logs.append(prior + np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(rows: DataFrame, regularisation: tuple[float, float] | None = None) -> Model:
    """A model from ``rows`` with ``label`` (0, 1), ``fold`` (inner) and ``x`` (array of statistics).

    ``regularisation`` is a choice like those in ``CHOICES``; without one the best of these is taken.
    """
    d = len(NAMES)
    size = 1 + d + d * d
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("sums", T.ArrayType(T.DoubleType()))]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums = np.zeros((2 * INNER_FOLDS, size))
        for batch in batches:
            x, part = _table(batch)
            for p in np.unique(part):
                own = x[part == p]
                sums[p, 0] += len(own)
                sums[p, 1 : 1 + d] += own.sum(axis=0)
                sums[p, 1 + d :] += (own.T @ own).ravel()
        yield {"part": list(range(2 * INNER_FOLDS)), "sums": sums.tolist()}

    partial = map_batches(rows.select("label", "fold", "x"), step, schema)
    total = partial.select("part", F.posexplode("sums")).groupBy("part", "pos").agg(F.sum("col"))
    sums = np.zeros((2 * INNER_FOLDS, size))
    for part, position, value in total.collect():  # a fixed number of rows
        sums[part, position] = value
    sums = sums.reshape(INNER_FOLDS, 2, size)
    whole = sums.sum(axis=0)
    if regularisation is None:
        regularisation = CHOICES[0] if whole[:, 0].min() == 0 else _chosen(rows, whole - sums)
    return model_of(whole, *regularisation)


def _table(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Statistics, and fold and label as one number."""
    x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(NAMES))
    label = np.array(batch.column("label").to_pylist(), int)
    return x, 2 * np.array(batch.column("fold").to_pylist(), int) + label


def _chosen(rows: DataFrame, others: np.ndarray) -> tuple[float, float]:
    """The choice with the smallest log loss, each row scored by a model of the other inner folds' sums."""
    models = [[model_of(sums, *choice) for choice in CHOICES] for sums in others]
    schema = T.StructType(
        [T.StructField("n", T.LongType()), T.StructField("losses", T.ArrayType(T.DoubleType()))]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, losses = 0, np.zeros(len(CHOICES))
        for batch in batches:
            x, part = _table(batch)
            n += len(x)
            for p in np.unique(part):
                own = x[part == p]
                for c, model in enumerate(models[p // 2]):
                    right = model.score(own) if p % 2 else 1 - model.score(own)
                    losses[c] -= np.log(np.maximum(right, 1e-9)).sum()
        yield {"n": [n], "losses": [losses.tolist()]}

    partial = map_batches(rows.select("label", "fold", "x"), step, schema)
    n = F.sum("n").alias("n")
    summed = partial.agg(n, *[F.sum(F.col("losses")[c]).alias(f"c{c}") for c in range(len(CHOICES))]).first()
    means = [round(summed[f"c{c}"] / summed["n"], LOSS_DIGITS) for c in range(len(CHOICES))]
    return CHOICES[means.index(min(means))]


def model_of(sums: np.ndarray, shrinkage: float, least_variance: float) -> Model:
    """A model from each class's count, sums and sums of products."""
    d = len(NAMES)
    n = sums[:, 0]
    if n.min() == 0:
        return Model([], float((n[1] + 1) / (n.sum() + 2)))
    means = sums[:, 1 : 1 + d] / n[:, None]
    second = sums[:, 1 + d :].reshape(2, d, d) / n[:, None, None]
    spread = second - means[:, :, None] * means[:, None, :]
    pooled = np.diag(np.diag((n[:, None, None] * spread).sum(axis=0) / n.sum()))
    parts = []
    for label in (0, 1):
        shrunk = (1 - shrinkage) * spread[label] + shrinkage * pooled
        lower = np.linalg.cholesky(shrunk + least_variance * np.eye(d))
        parts.append((float(np.log(n[label] / n.sum())), means[label], np.linalg.inv(lower)))
    return Model(parts)


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` and ``x``, its statistics."""
    rest = [f for f in docs.schema if f.name != text]
    schema = T.StructType([*rest, T.StructField("x", T.ArrayType(T.DoubleType()))])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = {f.name: batch.column(f.name) for f in rest}
            yield columns | {"x": [statistics(t) for t in utf8(batch, text)]}

    return map_batches(docs, step, schema)


def learned(
    found: DataFrame, labels: DataFrame, regularisation: tuple[float, float] | None = None
) -> Model:
    """A model from rows (doc_id, x) and labels (doc_id, quality) that are not held out."""
    known = labels.where("quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    inner = F.concat(F.lit("inner "), F.col("doc_id").cast("string")).cast("binary")
    rows = found.join(known, "doc_id").select("label", (F.crc32(inner) % INNER_FOLDS).cast("int").alias("fold"), "x")
    return fit(materialize(rows, "quality-labelled"), regularisation)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    regularisation: tuple[float, float] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold)."""
    found = materialize(described(docs.select("doc_id", "text")), "quality")
    model = learned(found, labels, regularisation)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(NAMES))
            yield {"doc_id": batch.column("doc_id"), "score": model.score(x)}

    return map_batches(found, step, schema).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    regularisation: tuple[float, float] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that reach the threshold, with all columns; learns from the same rows."""
    # Texts are read twice rather than shuffled: only their statistics meet the labels.
    found = materialize(described(docs.select("doc_id", "text")), "quality")
    model = learned(found, labels, regularisation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in utf8(batch, "text")], float)
            good = model.score(x.reshape(-1, len(NAMES))) >= threshold
            yield batch.filter(pa.array(good, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
