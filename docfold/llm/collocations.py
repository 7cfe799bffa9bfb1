"""Phrase collocations by vertically partitioned suffix trees.

A suffix is what follows a place in a piece of text, cut to ``DEPTH`` words. A phrase that occurs ``LEAST`` times
needs words that do, and pairs of neighbours that do; so words are counted first, then pairs, and a
suffix ends early where a pair is too rare. What is rare is told by bit tables of hashes, sized by the number of
entries and bounded by ``TABLE_BITS``: a collision keeps a rare one, which costs work and changes no count.

Equal suffixes become one leaf with a total. Word prefixes are then grouped by a memory budget: a prefix with
more than ``BUDGET_LEAVES / 8`` leaves is made longer by a word until it has fewer or is a whole leaf, and all
prefixes are dealt into groups of about ``BUDGET_LEAVES`` leaves. Each group builds its subtrees on its own (leaves in
word order; a node is a run of equal prefixes) and reads a node's count from its leaves' totals. Nodes above a
lengthened prefix get a part from each group, and the parts are added.

A candidate is a phrase of 2 to ``DEPTH`` words with a = f(phrase) >= ``LEAST``. Cut after its first k words, it has
l = f(first part), r = f(rest) and score floor(2000000 a / (l + r)); the lowest score counts, ties go to the smallest k.
Candidates that stand inside a longer one with 100 f(longer) >= 80 a go, then the best ``TOP`` of a
language stay: by score and a falling, phrase rising in byte order. Products are decimals, so they are exact.

Texts are used whole, in parts of about ``PART_BYTES``. Null texts are empty, null languages are ``und``; empty texts and
an empty table give no words. Repeated rows count each. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import map_batches
from docfold.session import materialize

LEAST = 30
DEPTH = 4
TOP = 2000
COVER = 80
SCALE = 2_000_000
#: Leaves a group of subtrees may hold.
BUDGET_LEAVES = 200_000
#: Heavy prefixes of a length up to this many are part of the plan; longer lists are joined by shuffle.
SMALL_ROWS = 10_000
#: Most bits of a table of frequent hashes (16 MB), and bits per entry below that.
TABLE_BITS = 1 << 27
BITS_PER_ENTRY = 16
PART_BYTES = 4 << 20
PAIRS_HELD = 2_000_000
RANK_SALTS = 32

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: 1 for what separates words, 2 for what ends a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts: codes into a dictionary, and the piece each stands in."""

    def __init__(self, texts: list[bytes]):
        # A line break between texts ends a piece.
        data = np.frombuffer(b"\n".join(texts).translate(_LOWER), np.uint8)
        kind = _KIND[data]
        inside = np.concatenate([[False], kind == 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_string(),
            len(starts),
            [None, pa.py_buffer(offsets), pa.py_buffer(data[kind == 0])],
        )
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.dictionary = coded.dictionary

    def hashes(self, lang: str) -> np.ndarray:
        """What ``xxhash64(lang, word)`` gives for the words of the dictionary."""
        seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        found = [xxhash.xxh64_intdigest(w, seed) for w in self.dictionary.cast(pa.large_binary()).to_pylist()]
        return np.array(found, np.uint64)

    def neighbours(self, known: np.ndarray) -> np.ndarray:
        """Whether a word and its next one are of one piece and both known."""
        pair = np.zeros(len(self.codes), bool)
        if len(pair) > 1:
            ok = known[self.codes]
            pair[:-1] = (self.piece[1:] == self.piece[:-1]) & ok[1:] & ok[:-1]
        return pair


class Bits:
    """A set of hashes as a table of bits; says yes to all of the set, and to some others."""

    def __init__(self, words: np.ndarray):
        """``words`` are 32 bits each; their number is a power of two."""
        self.table = words.astype("<u4").view(np.uint8)
        self.mask = np.uint64(8 * len(self.table) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        shift = (place & np.uint64(7)).astype(np.uint8)
        return (self.table[(place >> np.uint64(3)).astype(np.int64)] >> shift) & 1 == 1


def frequent(hashes: DataFrame) -> Bits:
    """A bit table of the column ``h``; the driver gets at most ``TABLE_BITS`` / 32 rows."""
    size = 1 << max(10, math.ceil(math.log2(max(1, hashes.count()) * BITS_PER_ENTRY)))
    size = min(size, TABLE_BITS)
    place = F.col("h").bitwiseAND(F.lit(size - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(31)).cast("int"))
    found = hashes.select(F.shiftright(place, 5).alias("word"), bit.alias("bit"))
    got = found.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(size // 32, np.uint32)
    words[got.column("word").to_numpy()] = got.column("bits").to_numpy().astype(np.uint32)
    return Bits(words)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """The words of each batch by language, of about ``PART_BYTES`` of whole texts at a time."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        held: dict[str, list] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(langs, texts, strict=True):
            own = held.setdefault(lang, [])
            own.append(text.as_py())
            sizes[lang] = sizes.get(lang, 0) + len(own[-1])
            if sizes[lang] >= PART_BYTES:
                yield lang, Words(held.pop(lang))
                sizes[lang] = 0
        for lang, own in held.items():
            yield lang, Words(own)


def _said(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), "text"
    ).where("text IS NOT NULL")


def word_counts(documents: DataFrame) -> DataFrame:
    """lang, phrase (a word), a: every word."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for lang, words in _parts(batches):
            n = np.bincount(words.codes, minlength=len(words.dictionary))
            yield {"lang": [lang] * len(n), "phrase": words.dictionary, "a": n}

    counted = map_batches(_said(documents), step, T.StructType.fromDDL("lang string, phrase string, a long"))
    return counted.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _pair_hashes(words: Words, hashes: np.ndarray, pair: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(pair)
    first, second = hashes[words.codes[at]], hashes[words.codes[at + 1]]
    mixed = first * _MIX + (second ^ (second >> np.uint64(29)))
    return (mixed ^ (mixed >> np.uint64(32))) * _MIX


def pair_counts(documents: DataFrame, words: Bits) -> DataFrame:
    """h, a: number of places per hash of two neighbours that are both frequent."""
    known = documents.sparkSession.sparkContext.broadcast(words)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for lang, words in _parts(batches):
            hashes = words.hashes(lang)
            pairs = _pair_hashes(words, hashes, words.neighbours(known.value.has(hashes)))
            held.append(np.unique(pairs.view(np.int64), return_counts=True))
            n += len(held[-1][0])
            if n >= PAIRS_HELD:
                yield dict(zip("ha", _added(held), strict=True))
                held, n = [], 0
        if n:
            yield dict(zip("ha", _added(held), strict=True))

    counted = map_batches(_said(documents), step, T.StructType.fromDDL("h long, a long"))
    return counted.groupBy("h").agg(F.sum("a").alias("a"))


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in held])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([n for _, n in held])[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def leaves(documents: DataFrame, words: Bits, pairs: Bits, depth: int = DEPTH) -> DataFrame:
    """lang, leaf (2 to ``depth`` words joined by blanks), n: suffixes with their totals."""
    known = documents.sparkSession.sparkContext.broadcast((words, pairs))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words_known, pairs_known = known.value
        for lang, words in _parts(batches):
            hashes = words.hashes(lang)
            pair = words.neighbours(words_known.has(hashes))
            pair[pair] = pairs_known.has(_pair_hashes(words, hashes, pair))
            at = np.flatnonzero(pair)
            columns, goes_on = [words.codes[at]], np.ones(len(at), bool)
            for d in range(1, depth):
                # A suffix goes on while each word has a known pair with the next.
                before = np.minimum(at + d - 1, len(pair) - 1)
                goes_on = goes_on & pair[before]
                nexts = words.codes[np.minimum(at + d, len(pair) - 1)]
                columns.append(np.where(goes_on, nexts, -1))
            rows, n = _distinct(columns)
            text = [words.dictionary.take(pa.array(c, mask=c < 0)) for c in rows]
            yield {"lang": [lang] * len(n), "leaf": _joined(text), "n": n}

    cut = map_batches(_said(documents), step, T.StructType.fromDDL("lang string, leaf string, n long"))
    return cut.groupBy("lang", "leaf").agg(F.sum("n").alias("n"))


def _joined(words: list[pa.Array]) -> pa.Array:
    """Words in a row with a blank between; nulls are left out."""
    blank = pa.scalar(" ", words[0].type)
    return pc.binary_join_element_wise(*words, blank, null_handling="skip")


def _distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of some columns of codes (-1 for none), and how often each stands there."""
    place, firsts = columns[0], None
    for column in columns[1:]:
        # A number per row so far, then one per row with the next column.
        key = place << 32 | (column + 1)
        _, firsts, place, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return [c[firsts] for c in columns], n


def _prefix(words: Column) -> Column:
    """The first words of a leaf, or all if it has fewer."""
    return F.call_function("substring_index", F.col("leaf"), F.lit(" "), words)


def grouped(stored: DataFrame, budget: int = BUDGET_LEAVES) -> DataFrame:
    """Add ``cut``, the number of words in a leaf's prefix, and ``part``, the group of that prefix.

    ``stored`` is a written table. A heavy prefix has more than its share of the leaves, so
    of each length there are fewer of them than 8 per group.
    """
    named = lambda d: _prefix(F.lit(d)).alias("leaf")
    # Leaves per prefix, longest first: those of a shorter one are the sum.
    weights, frame, cut = [], stored.select("lang", "leaf", F.lit(1).alias("n")), F.lit(1)
    for d in range(DEPTH - 1, 0, -1):
        frame = frame.groupBy("lang", named(d)).agg(F.sum("n").alias("n"))
        frame = materialize(frame, "collocations-prefixes")
        weights.append((d, frame.where(F.col("n") > budget / 8)))
    found = stored
    # Prefixes of a heavy one are heavy too, so the marks add up.
    for d, heavy in weights:
        # Words hold no line break, so a line names the language and the prefix.
        line = lambda prefix: F.concat_ws("\n", "lang", prefix)
        if heavy.count() <= SMALL_ROWS:
            listed = [r[0] for r in heavy.select(line(F.col("leaf"))).collect()]
            cut = cut + F.when(line(_prefix(F.lit(d))).isin(listed), 1).otherwise(0)
            continue
        listed = heavy.select(line(F.col("leaf")).alias("line"), F.lit(1).alias(f"heavy{d}"))
        found = found.withColumn("line", line(_prefix(F.lit(d)))).join(listed, "line", "left").drop("line")
        cut = cut + F.coalesce(f"heavy{d}", F.lit(0))
    found = found.select("lang", "leaf", "n", cut.cast("int").alias("cut"))
    parts = max(1, -(-stored.count() // budget))
    place = F.xxhash64("lang", _prefix(F.col("cut")))
    return found.withColumn("part", F.pmod(place, F.lit(parts)).cast("int"))


def subtrees(group: pa.Table, depth: int = DEPTH, least: int = LEAST) -> pa.Table:
    """The nodes of a group's subtrees: lang, phrase, a, whole (else a part of the node's total)."""
    split = pc.split_pattern(group.column("leaf").combine_chunks(), " ")
    lengths = pc.list_value_length(split).to_numpy()
    coded = split.flatten().dictionary_encode()
    codes = np.full((len(lengths), depth), -1, np.int64)
    codes[np.arange(depth) < lengths[:, None]] = coded.indices.to_numpy()
    langs = group.column("lang").combine_chunks().dictionary_encode()
    own = langs.indices.to_numpy()
    order = np.lexsort((*codes.T[::-1], own))
    codes, own = codes[order], own[order]
    n, cut = (group.column(c).to_numpy()[order] for c in ("n", "cut"))
    out = []
    starts_here = np.concatenate([[True], own[1:] != own[:-1]])
    for d in range(1, depth + 1):
        starts_here = starts_here | np.concatenate([[True], codes[1:, d - 1] != codes[:-1, d - 1]])
        if d == 1:
            continue
        starts = np.flatnonzero(starts_here)
        totals = np.add.reduceat(n, starts)
        whole = cut[starts] <= d
        good = (codes[starts, d - 1] >= 0) & (~whole | (totals >= least))
        starts = starts[good]
        words = [coded.dictionary.take(pa.array(codes[starts, i])) for i in range(d)]
        phrase = _joined(words)
        lang = langs.dictionary.take(pa.array(own[starts]))
        out.append(
            pa.table({"lang": lang, "phrase": phrase, "a": totals[good], "whole": whole[good]})
        )
    return pa.concat_tables(out)


def phrase_counts(documents: DataFrame, words: DataFrame, budget: int = BUDGET_LEAVES) -> DataFrame:
    """lang, phrase, a: phrases of 2 to ``DEPTH`` words with a >= ``LEAST``. ``words`` is a written table."""
    known = frequent(words.where(F.col("a") >= LEAST).select(F.xxhash64("lang", "phrase").alias("h")))
    pairs = materialize(pair_counts(documents, known).where(F.col("a") >= LEAST), "collocations-pairs")
    stored = materialize(leaves(documents, known, frequent(pairs)), "collocations-leaves")
    nodes = (
        grouped(stored, budget)
        .groupBy("part")
        .applyInArrow(_nodes, "lang string, phrase string, a long, whole boolean")
    )
    nodes = materialize(nodes, "collocations-nodes")
    parts = nodes.where("not whole").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    whole = nodes.where("whole").select("lang", "phrase", "a")
    return whole.union(parts.where(F.col("a") >= LEAST))


def _nodes(group: pa.Table) -> pa.Table:
    return subtrees(group)


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer one covers.

    ``phrases`` and ``words`` are written tables; all facts of a candidate meet in one grouping.
    """
    size = F.size(F.split("phrase", " "))
    sides = phrases.select(
        "lang", "phrase", size.alias("size"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    )
    cut = lambda n: F.call_function("substring_index", F.col("phrase"), F.lit(" "), n)
    both = F.array(
        F.struct(F.lit("l").alias("side"), cut(F.col("k")).alias("part")),
        F.struct(F.lit("r").alias("side"), cut(F.col("k") - F.col("size")).alias("part")),
    )
    sides = sides.select("lang", "phrase", "k", F.inline(both))
    counts = words.where(F.col("a") >= LEAST).select("lang", "phrase", "a").union(phrases)
    counts = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    sides = sides.join(counts, ["lang", "part"]).select("lang", "phrase", "k", "side", "f")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda m: F.transform(
                F.sequence(F.lit(1), size - m + 1),
                lambda i: F.array_join(F.slice(F.split("phrase", " "), i, m), " "),
            ),
        )
    )
    covers = phrases.select(
        "lang", F.explode(F.when(size > 2, inner)).alias("phrase"), F.col("a").alias("f")
    )
    none = [F.lit(None).cast("int").alias("k")]
    covers = covers.select("lang", "phrase", *none, F.lit("longer").alias("side"), "f")
    own = phrases.select("lang", "phrase", *none, F.lit("own").alias("side"), F.col("a").alias("f"))
    fact = lambda side, k=None: F.max(
        F.when((F.col("side") == side) & (F.lit(True) if k is None else F.col("k") == k), F.col("f"))
    )
    facts = {"a": fact("own"), "longer": fact("longer")}
    for k in range(1, DEPTH):
        facts |= {f"l{k}": fact("l", k), f"r{k}": fact("r", k)}
    met = sides.union(covers).union(own).groupBy("lang", "phrase")
    met = met.agg(*[c.alias(name) for name, c in facts.items()]).where("a IS NOT NULL")
    big = "cast({0} AS decimal(20,0))"
    covered = f"{big.format('longer')} * 100 >= {big.format('a')} * {COVER}"
    met = met.where(f"longer IS NULL OR NOT ({covered})")
    cuts = [
        f"CASE WHEN l{k} IS NOT NULL THEN named_struct('score',"
        f" ({big.format('a')} * {SCALE}) div {big.format(f'(l{k} + r{k})')},"
        f" 'k', {k}, 'l', l{k}, 'r', r{k}) END"
        for k in range(1, DEPTH)
    ]
    best = F.expr(f"least({', '.join(cuts)})")
    return met.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(documents: DataFrame, top: int = TOP, budget: int = BUDGET_LEAVES) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n (words of the language), score."""
    words = materialize(word_counts(documents), "collocations-words")
    phrases = materialize(phrase_counts(documents, words, budget), "collocations-phrases")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    found = scored(phrases, words).withColumn(
        "salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS))
    )
    # The best of each share first, so that one task gets no more than those of all shares.
    for keys in (["lang", "salt"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", place).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    return found.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
