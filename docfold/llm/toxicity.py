"""Toxicity: boosted trees over dense features, calibrated isotonically.

A lexicon of words and word beginnings is learned from labels: entries that come far more often in
toxic texts. A text's features are how dense, strong and varied its lexicon hits are, how near they
stand to a second-person pronoun, and rates of capitals, punctuation and obfuscated words. Boosted
trees turn them into a margin, and an isotonic curve turns the margin into a score.

Fitted on at most ``SAMPLE_ROWS`` labelled rows that are not held out (those with the smallest hash of the
id), in three disjoint parts: for the lexicon, the trees and the curve. Everything else covers all
rows and whole texts. Null and empty texts are the same and get a score like any other. Null labels are not learned
from; several labels of one id count as the largest; repeated rows are scored each; a null id is
never learned from. Without labels the score is 0.5 for every row. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm import boosting
from docfold.llm.common import map_batches
from docfold.llm.quality import held_out
from docfold.session import materialize

SAMPLE_ROWS = 20_000
LEXICON_ROWS = 4_000
#: An entry has to come in so many toxic texts of the sample, and so much more often than elsewhere.
LEAST_TEXTS, LEAST_LOG_ODDS = 4, 1.5
BEGINNINGS = (4, 5, 6)
NEAR_WORDS = 5
THRESHOLD = 0.5
#: Folded tokens a task remembers.
MEMORY = 200_000

#: Pronouns of the second person (English, German, French, Spanish).
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous "
    "votre vos tú ti tus usted ustedes vosotros os".split()
)
_LEET = str.maketrans("013457@$", "oieastas")
_LETTERS = re.compile(r"[^\W\d_]+")
_LONG_RUN = re.compile(r"(.)\1{2,}")

NAMES = (
    "log_words", "hit_density", "strong_density", "weight_density", "max_weight", "log_hits",
    "log_distinct", "hits_near_you", "you_density", "capitals", "capital_words", "marks",
    "punctuation", "obfuscated", "obfuscated_hits",
)


def folded(token: str) -> tuple[str, bool]:
    """A token as a plain word, and whether it was obfuscated: letters replaced, split or repeated."""
    bare = token.strip(".,;:!?\"'()[]{}«»„“”…-*#%&|")
    if bare.isalpha():
        word = _LONG_RUN.sub(r"\1", bare)
        return word, len(word) < len(bare)
    plain = "".join(_LETTERS.findall(bare.translate(_LEET)))
    return _LONG_RUN.sub(r"\1", plain), bool(plain) and any(c.isalpha() for c in bare)


def entries(word: str) -> list[str]:
    """What a lexicon can hold of a word: the word, and its beginnings."""
    if len(word) < 3:
        return []
    return [word, *(word[:k] + "-" for k in BEGINNINGS if len(word) > k)]


class Reader:
    """Features of texts, for a lexicon of weights."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.known: dict[str, tuple[float, bool, bool]] = {}

    def of_token(self, token: str) -> tuple[float, bool, bool]:
        """Weight, second person, obfuscated."""
        if (found := self.known.get(token)) is None:
            word, hidden = folded(token)
            weight = max((self.lexicon.get(e, 0.0) for e in entries(word)), default=0.0)
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = self.known[token] = (weight, word in SECOND_PERSON, hidden)
        return found

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        tokens = text.lower().split()
        n = max(1, len(tokens))
        of, counts = self.of_token, Counter(tokens)
        hits, strong, total, top, distinct, you, hidden, hidden_hits = 0, 0, 0.0, 0.0, 0, 0, 0, 0
        marked = {}
        for token, times in counts.items():
            weight, second, obfuscated = of(token)
            you += times * second
            hidden += times * obfuscated
            if weight:
                hits += times
                distinct += 1
                total += times * weight
                top = max(top, weight)
                strong += times * (weight >= 3)
                hidden_hits += times * obfuscated
            if weight or second:
                marked[token] = weight
        near = self._near(tokens, marked) if hits and you else 0
        letters = max(1, len(text) - len(tokens))
        capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        return [
            np.log1p(len(tokens)), hits / n, strong / n, total / n, top, np.log1p(hits),
            np.log1p(distinct), near / max(1, hits), you / n, capitals / letters,
            sum(map(str.isupper, text.split())) / n, (text.count("!") + text.count("?")) / n,
            sum(map(text.count, ".,;:")) / n, hidden / n, hidden_hits / n,
        ]

    def _near(self, tokens: list[str], marked: dict[str, float]) -> int:
        """Hits within ``NEAR_WORDS`` words of a second-person pronoun."""
        hits, others = [], []
        for i, token in enumerate(tokens):
            if token in marked:
                (hits if marked[token] else others).append(i)
        if not others:
            return 0
        others = np.array(others)
        at = np.searchsorted(others, hits)
        left = np.abs(np.array(hits) - others[np.maximum(at - 1, 0)])
        right = np.abs(others[np.minimum(at, len(others) - 1)] - np.array(hits))
        return int((np.minimum(left, right) <= NEAR_WORDS).sum())


@dataclass
class Model:
    trees: boosting.Trees
    curve: boosting.Isotonic

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.curve.apply(self.trees.margin(x))


def sample_of(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, label and part (0 to 9) of the sampled rows; at most ``rows`` ids."""
    known = labels.where("toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    # All but a little more than the wanted share go before the ordering, so that tasks send few.
    share = min(1.0, 1.2 * rows / max(1, known.count()))
    near = known.where(place <= int(share * (1 << 40)))
    # The limit is the documented bound of the sample, so it may be broadcast.
    chosen = near.orderBy(place, "doc_id").limit(rows).withColumn("part", F.pmod(place, F.lit(10)))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def learn_lexicon(sample: DataFrame, rows: int = LEXICON_ROWS) -> dict[str, float]:
    """The ``rows`` most telling entries, with log odds as weights. Each text counts an entry once."""
    schema = T.StructType(
        [
            T.StructField("entry", T.StringType()),
            T.StructField("toxic", T.LongType()),
            T.StructField("other", T.LongType()),
        ]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            counts = Counter(), Counter()
            labels, texts = batch.column("label").to_pylist(), batch.column("text").to_pylist()
            for label, text in zip(labels, texts, strict=True):
                words = {folded(t)[0] for t in set((text or "").lower().split())}
                counts[label].update({e for w in words for e in entries(w)})
                counts[label][""] += 1  # the number of texts
            names = list(counts[0].keys() | counts[1].keys())
            yield {
                "entry": names,
                "toxic": [counts[1][e] for e in names],
                "other": [counts[0][e] for e in names],
            }

    found = map_batches(sample.select("label", "text"), step, schema)
    found = found.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    found = materialize(found, "toxicity-lexicon")
    texts = found.where("entry = ''").first()
    if texts is None or not texts.toxic or not texts.other:
        return {}
    rate = lambda count, of: F.log((F.col(count) + 0.5) / (of + 1.0))
    odds = rate("toxic", texts.toxic) - rate("other", texts.other)
    sure = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    best = found.where((F.col("entry") != "") & (F.col("toxic") >= LEAST_TEXTS))
    best = best.select("entry", odds.alias("odds"), sure.alias("sure"))
    best = best.where(F.col("odds") >= LEAST_LOG_ODDS).orderBy(F.desc("sure"), "entry").limit(rows)
    return {r.entry: r.odds for r in best.collect()}


def described(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """Columns of ``docs`` but the text, and ``x``, its features."""
    rest = [f for f in docs.schema if f.name != "text"]
    schema = T.StructType([*rest, T.StructField("x", T.ArrayType(T.DoubleType()))])
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader = Reader(shared.value)
        for batch in batches:
            columns = {f.name: batch.column(f.name) for f in rest}
            yield columns | {"x": [reader.features(t) for t in batch.column("text").to_pylist()]}

    return map_batches(docs, step, schema)


def fit(sample: DataFrame) -> tuple[Model, dict[str, float]]:
    """Half of the sample for the lexicon, three tenths for the trees, the rest for the curve."""
    lexicon = learn_lexicon(sample.where("part < 5"))
    rest = described(sample.where("part >= 5"), lexicon).select("part", "label", "x").collect()
    x = np.array([r.x for r in rest], float).reshape(-1, len(NAMES))
    y, part = np.array([r.label for r in rest], float), np.array([r.part for r in rest])
    first = part < 8
    trees = boosting.boost(x[first], y[first])
    return Model(trees, boosting.calibrate(trees.margin(x[~first]), y[~first])), lexicon


def toxicity(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold)."""
    sample = materialize(sample_of(docs, labels, rows), "toxicity-sample")
    model, lexicon = fit(sample)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model, lexicon))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trained, words = shared.value
        reader = Reader(words)
        for batch in batches:
            x = np.array([reader.features(t) for t in batch.column("text").to_pylist()], float)
            score = trained.score(x.reshape(-1, len(NAMES)))
            yield {"doc_id": batch.column("doc_id"), "score": score}

    return map_batches(docs.select("doc_id", "text"), step, schema).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
