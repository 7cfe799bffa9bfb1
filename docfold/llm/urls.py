"""URL filters: rules by host and path, and a classifier over segmented host names for the rest.

A rule (host, path) fits its host and all subdomains if the url's path starts with the rule's; the longest
rule wins. What no rule fits is judged by words: names like ``cheappills`` are split by a unigram Viterbi
search into the most likely words, and a multinomial naive Bayes scores the words of the host and of the path.

Word frequencies come from the text of all pages; the ``DICTIONARY_WORDS`` most frequent are used, and anything
else can be split into single unknown pieces at a price that grows with their length. The Bayes counts come from all
urls, which are labelled by the fixed ``BAD_WORDS``: a url whose host holds one is an example of
class block. Words are hashed to ``BUCKETS``, so the model has one size whatever the data.

Null urls and urls without ``://`` have an empty host and path, fit no rule and are judged by the prior alone.
Rows are judged one by one, so repeated ones get the same verdict. A very long host is split in time
linear in its length. Without pages there are no rows. Columns other than page_id, url, html are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import map_batches
from docfold.session import materialize

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words of host names that mark unwanted sites.
BAD_WORDS = frozenset(
    "ad ads adult adults bet bets betting casino casinos crack escort escorts gambling hack keygen loan loans "
    "lottery malware naked nude payday phishing pill pills poker porn replica sex slots spam torrent "
    "track tracker tracking viagra warez xxx".split()
)
#: Words that host names are often made of, so that they are split off even if rare in texts.
HOST_WORDS = frozenset(
    "blog cheap click cloud dating deal deals discount farm free game games girl girls hot info link links live "
    "mail money news online play rich sale shop site store stream video videos web win winner www".split()
)
DICTIONARY_WORDS = 50_000
LONGEST_WORD = 24
BUCKETS = 1 << 16
#: Small, because most buckets are empty.
SMOOTHING = 0.01
#: Host names a task remembers.
MEMORY = 100_000
_PIECE = re.compile(r"[a-z]+|\d+|[^\x00-\x7f]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0)
    path = F.regexp_extract(
        F.coalesce(rest, F.lit("")).substr(F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(raw, upper, lower), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits as (rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        named = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def dictionary(texts: DataFrame, column: str, size: int = DICTIONARY_WORDS) -> dict[str, int]:
    """The most frequent words of all texts, tags aside, with their counts; at most ``size``.

    The least count that still counts comes from the numbers of words per count, so that no more
    than the dictionary itself comes to the driver. Words tied at that count come all or not at all.
    """
    plain = F.lower(F.regexp_replace(F.col(column), r"<[^>]*>", " "))
    words = texts.select(F.explode(F.split(plain, r"[^a-z]+")).alias("word"))
    words = words.where(F.length("word").between(2, LONGEST_WORD))
    counts = materialize(words.groupBy("word").count(), "words")
    alike = counts.groupBy("count").agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy(F.desc("count")))
    least = alike.withColumn("r", running).where(F.col("r") <= size).agg(F.min("count")).first()[0]
    frequent = counts.where(F.col("count") >= least) if least else counts.limit(0)
    found = {r["word"]: r["count"] for r in frequent.collect()}
    typical = max(1, sum(found.values()) // 1000)
    for word in BAD_WORDS | HOST_WORDS:
        found[word] = max(typical, found.get(word, 0))
    return found


class Segmenter:
    """Most likely splits of names into words."""

    def __init__(self, counts: dict[str, int]):
        self.total = sum(counts.values()) + 1
        self.cost = {w: float(np.log(self.total / n)) for w, n in counts.items()}
        self.known: dict[str, list[str]] = {}

    def unknown(self, length: int) -> float:
        """Dearer than any word, and dearer still with each letter."""
        return float(np.log(self.total)) + 2.0 * length

    def split(self, name: str) -> list[str]:
        """Words of a name, with unknown stretches as pieces of at most ``LONGEST_WORD``."""
        best, start = [0.0], [0]
        for end in range(1, len(name) + 1):
            options = []
            for begin in range(max(0, end - LONGEST_WORD), end):
                piece = name[begin:end]
                cost = self.cost.get(piece)
                cost = self.unknown(len(piece)) if cost is None else cost
                options.append((best[begin] + cost, begin))
            cost, begin = min(options)
            best.append(cost)
            start.append(begin)
        out, end = [], len(name)
        while end:
            out.append(name[start[end] : end])
            end = start[end]
        return out[::-1]

    def words(self, text: str) -> list[str]:
        """All words of a host or path; digits count as one sort of word."""
        if (found := self.known.get(text)) is None:
            found = []
            for piece in _PIECE.findall(text.lower()):
                found.extend(["0"] if piece[0].isdigit() else self.split(piece))
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[text] = found
        return found


def tokens(segmenter: Segmenter, host: str, path: str) -> tuple[list[str], list[str]]:
    return segmenter.words(host), segmenter.words(path)


def buckets(host: list[str], path: list[str]) -> list[int]:
    named = [*("h:" + w for w in host), *("p:" + w for w in path)]
    return [xxhash.xxh32_intdigest(t) % BUCKETS for t in named]


def learn(urls: DataFrame, counts: dict[str, int]) -> tuple[float, np.ndarray]:
    """Log odds of block: the prior, and of each bucket. ``urls`` has host and path."""
    schema = T.StructType(
        [
            T.StructField("bucket", T.IntegerType()),
            T.StructField("bad", T.LongType()),
            T.StructField("good", T.LongType()),
        ]
    )
    shared = urls.sparkSession.sparkContext.broadcast(counts)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        segmenter, sums = Segmenter(shared.value), (Counter(), Counter())
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("host", "path"))
            for host, path in zip(*columns, strict=True):
                names, rest = tokens(segmenter, host, path)
                own = sums[not BAD_WORDS.isdisjoint(names)]
                own.update(buckets(names, rest))
                own[-1] += 1  # the number of urls
        keys = sorted(sums[0].keys() | sums[1].keys())
        yield {
            "bucket": keys,
            "bad": [sums[1][k] for k in keys],
            "good": [sums[0][k] for k in keys],
        }

    found = map_batches(urls.select("host", "path"), step, schema).groupBy("bucket")
    table, urls_of = np.zeros((BUCKETS, 2)), np.zeros(2)
    for bucket, bad, good in found.agg(F.sum("bad"), F.sum("good")).collect():  # at most BUCKETS + 1 rows
        if bucket < 0:
            urls_of[:] = bad, good
        else:
            table[bucket] = bad, good
    shares = (table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * BUCKETS)
    odds = np.log(shares[:, 0]) - np.log(shares[:, 1])
    return float(np.log((urls_of[0] + 1) / (urls_of[1] + 1))), odds


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    words: int = DICTIONARY_WORDS,
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, log_odds (of block, by words), host_words."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    counts = dictionary(pages, "html", words)
    prior, odds = learn(urls, counts)
    shared = pages.sparkSession.sparkContext.broadcast((counts, prior, odds))
    schema = T.StructType(
        [
            *urls.schema,
            T.StructField("log_odds", T.DoubleType()),
            T.StructField("host_words", T.ArrayType(T.StringType())),
        ]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts, prior, odds = shared.value
        segmenter = Segmenter(counts)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("host", "path"))
            split = [tokens(segmenter, h, p) for h, p in zip(*columns, strict=True)]
            yield {
                **{c: batch.column(c) for c in ("page_id", "host", "path")},
                "log_odds": [prior + float(odds[buckets(h, p)].sum()) for h, p in split],
                "host_words": [h for h, _ in split],
            }

    scored = map_batches(urls, step, schema)
    chosen = rule_for(F.col("host"), F.col("path"), rules)
    by_words = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    scored = scored.withColumn("chosen", chosen)
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("chosen.rule").alias("rule"),
        F.coalesce("chosen.verdict", by_words).alias("verdict"),
        "log_odds",
        "host_words",
    )
