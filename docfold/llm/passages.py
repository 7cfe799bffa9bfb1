"""Substring dedup: near-equal paragraphs found by MinHash banding, verified exactly, clustered by components.

A paragraph is a line of at least ``LEAST_WORDS`` words. A passage that several texts hold can also lie
inside a line or across lines of any length, so from texts of more than ``LONG_WORDS`` words stretches of
``STRETCH_WORDS`` words are taken as paragraphs too, from places chosen by content (the smallest hash of three
words in each window of ``ANCHOR_WINDOW``). Words before and after a line break are neighbours there. Two texts that
share a passage of ``ANCHOR_WINDOW + STRETCH_WORDS`` words choose a common place in it (one word less
suffices unless it begins with one word four times), so passages of 50 words and more are always found.

Each paragraph has ``BANDS * ROWS`` minimum hashes of its shingles. Paragraphs whose words are equal are one from
here on. Paragraphs that agree in a band meet there, and a pair is a link if the exact Jaccard
similarity of its shingles is at least ``SIMILARITY``. Each is paired with the band's first and with its
neighbour, which are all pairs of a band of three. In larger bands that then hold several classes,
paragraphs are sorted by further minimum hashes, in ``TURNS`` orders, and neighbours are paired; that joins nearly
all of a family without listing its pairs. What is still of different classes is paired by a prefix
filter: two paragraphs that are similar enough share one of their rarest shingles. Places in the order of rarity and
``BITS`` parities bound how many they share, so hardly a pair is compared in vain. So all pairs that meet end in one
class if they are similar. With 5 bands of 2 rows a pair at 0.8 meets with
probability 0.99, a pair at 0.9 with 0.9998. Of a class of linked paragraphs that stands in several documents, the
document with the smallest id keeps its own; all other occurrences are to be removed.

Words are whitespace-separated and compared with A-Z lowered; a passage is given by the positions of its words in the
text. Null and empty texts have no paragraph. Rows with equal doc_id are one document; rows without id are
one document too, which keeps nothing that another one has. Repeats within a document alone are no duplicates. Whole texts
are read; other columns are not.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import components, map_batches, utf8
from docfold.session import materialize

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 5, 2
LEAST_WORDS = 20
LONG_WORDS = 49
STRETCH_WORDS = 16
ANCHOR_WORDS, ANCHOR_WINDOW = 3, 33
#: Words that are read together, up to the end of a line.
BLOCK_WORDS = 1 << 18
#: Hashes of words, and paragraphs, that a task remembers.
MEMORY = 500_000
#: Stands for the document of rows without id where occurrences are looked up again.
NO_ID = (1 << 63) - 1
#: In a band of fewer paragraphs, the first and the neighbour make all pairs.
CROWD = 4
#: Bits of the filter that spares documents without a candidate a shuffle; it never drops one that has.
FILTER_BITS = 1 << 20
#: Parities of a set of shingles: those of two sets differ in at most as many as shingles that only one has.
BITS = 256
#: Orders in which paragraphs of a band become neighbours, and the minimum hashes that each sorts by.
TURNS, TURN_HASHES = 4, 8
#: Sets of shingles that are written at once.
BLOCK_SETS = 1 << 12

_RANDOM = np.random.default_rng(20)
_MULTIPLY = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_TURN = _RANDOM.integers(0, 1 << 64, (TURNS, TURN_HASHES), np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64((1 << 64) - 1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words."""
    n = len(words) - size + 1
    out = words[:n].copy()
    for i in range(1, size):
        out = out * _BASE + words[i : i + n]
    out ^= out >> np.uint64(29)
    return out * _BASE


def anchors(
    words: np.ndarray, starts: np.ndarray, first: np.ndarray, last: np.ndarray
) -> np.ndarray:
    """Places whose next words have the smallest hash of some window of places.

    ``words`` are the hashed words of texts that follow each other, each from one of ``starts``. Windows begin
    at the places from ``first`` up to ``last`` (exclusive) of each text.
    """
    own = _rolled(words, ANCHOR_WORDS)
    # A word repeated over and over would make every place the smallest of some window.
    same = np.zeros(len(own), bool)
    same[1:] = own[1:] == own[:-1]
    same[starts[starts < len(own)]] = False
    own[same] = _LAST
    some = first < last
    inside = np.zeros(len(own) + 1, np.int64)
    np.add.at(inside, first[some], 1)
    np.add.at(inside, last[some], -1)
    begins = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(begins):
        return begins
    windows = np.lib.stride_tricks.sliding_window_view(own, ANCHOR_WINDOW)
    # In parts, because a text can be very long.
    parts = np.array_split(begins, len(begins) // (1 << 16) + 1)
    chosen = np.unique(np.concatenate([x + windows[x].argmin(axis=1) for x in parts]))
    return chosen[own[chosen] < _LAST]


class Paragraphs:
    """Paragraphs of texts, read in blocks of lines.

    A text that goes on in the next block takes its last ``LONG_WORDS + 2`` words along: windows that begin
    from the third of them on are still to come; the place of the one before is known.
    """

    def __init__(self):
        self.hashes = _Hashes()

    def of(self, texts: Iterable[bytes | None]) -> Iterator[dict[str, np.ndarray]]:
        """Blocks of uid, text (its number), first, words (how many) and keys of paragraphs."""
        keep = LONG_WORDS + 2
        words, lines, parts = [], [], []
        for number, text in enumerate(texts):
            at, start, known = 0, len(words), False
            for line in (text or b"").lower().split(b"\n"):
                own = line.split()
                if len(own) >= LEAST_WORDS:
                    lines.append((number, at, len(words), len(own)))
                words.extend(own)
                at += len(own)
                if len(words) >= BLOCK_WORDS:
                    size = len(words) - start
                    parts.append((number, at - size, start, size, known, True))
                    yield from self._block(words, lines, parts)
                    known = known or size >= keep
                    words, lines, parts, start = words[-min(size, keep) :] if size else [], [], [], 0
            size = len(words) - start
            parts.append((number, at - size, start, size, known, False))
        yield from self._block(words, lines, parts)

    def _block(
        self, words: list[bytes], lines: list[tuple], parts: list[tuple]
    ) -> Iterator[dict[str, np.ndarray]]:
        number, at, starts, lengths = np.array(lines, np.int64).reshape(-1, 4).T
        hashed = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        places, text, first = self._stretches(hashed, parts)
        if not len(lines) + len(places):
            return
        own = [_name(words[a : a + n]) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
        own += [_name(words[a : a + STRETCH_WORDS]) for a in places.tolist()]
        yield {
            "uid": np.array(own, np.uint64).view(np.int64),
            "text": np.concatenate([number, text]),
            "first": np.concatenate([at, first]),
            "words": np.concatenate([lengths, np.full(len(places), STRETCH_WORDS)]),
            "keys": self._keys(_rolled(hashed, SHINGLE_WORDS), starts, lengths, places),
        }

    @staticmethod
    def _stretches(hashed: np.ndarray, parts: list[tuple]) -> tuple[np.ndarray, ...]:
        """Places of stretches in the block; the number of their text, and their place in it."""
        rows = np.array([p for p in parts if p[3]], np.int64).reshape(-1, 6)
        number, at, starts, lengths, known, more = rows.T
        # Of a text that goes on, only windows whose stretch is sure to be there, in a text sure to be long.
        last = starts + lengths - np.where(more, LONG_WORDS, ANCHOR_WORDS + ANCHOR_WINDOW - 2)
        last[(more == 0) & (at + lengths <= LONG_WORDS)] = 0
        last[(more == 1) & (known == 0) & (lengths < LONG_WORDS + 2)] = 0
        if len(hashed) < ANCHOR_WORDS + ANCHOR_WINDOW - 1:
            return (np.zeros(0, np.int64),) * 3
        places = anchors(hashed, starts, starts + known, last)
        if len(rows) and known[0] and last[0] > 1:
            # The window at the place 1 was the last one of the block before.
            done = anchors(hashed[: LONG_WORDS + 2], starts[:1], np.array([1]), np.array([2]))
            places = np.setdiff1d(places, done, assume_unique=True)
        part = np.searchsorted(starts, places, side="right") - 1
        fits = places + STRETCH_WORDS <= starts[part] + lengths[part]
        places, part = places[fits], part[fits]
        return places, number[part], at[part] + places - starts[part]

    @staticmethod
    def _keys(
        shingles: np.ndarray, starts: np.ndarray, lengths: np.ndarray, places: np.ndarray
    ) -> np.ndarray:
        """Band keys of whole lines and then of the stretches at ``places``."""
        # From each line's first shingle to behind its last; what lies between lines is left out.
        bounds = np.stack([starts, starts + lengths - SHINGLE_WORDS + 1], axis=1).ravel()
        bounds = bounds[:-1] if len(bounds) and bounds[-1] == len(shingles) else bounds
        width = STRETCH_WORDS - SHINGLE_WORDS + 1
        inside = places[:, None] + np.arange(width)
        smallest = []
        for m, a in zip(_MULTIPLY, _ADD, strict=True):
            value = shingles * m + a
            lines = np.minimum.reduceat(value, bounds)[::2] if len(bounds) else value[:0]
            smallest.append(np.concatenate([lines, value[inside].min(axis=1)]))
        return band_keys(np.stack(smallest, axis=1))


def _name(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words))


def band_keys(smallest: np.ndarray) -> np.ndarray:
    """One key per band from the minimum hashes of each row."""
    smallest = smallest.reshape(len(smallest), BANDS, ROWS)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(smallest), 1))
    for row in range(ROWS):
        keys = (keys ^ smallest[:, :, row]) * _BASE
        keys ^= keys >> np.uint64(31)
    return keys


def paragraphs(docs: DataFrame) -> DataFrame:
    """uid, doc_id, first, words and the keys k0, k1, ... of every paragraph, as a written table.

    Keys are null where the task has given those of the same paragraph shortly before.
    """
    names = [f"k{i}" for i in range(BANDS)]
    schema = T.StructType(
        [
            T.StructField("uid", T.LongType()),
            docs.schema["doc_id"],
            T.StructField("first", T.LongType()),
            T.StructField("words", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in names),
        ]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader, seen = Paragraphs(), set()
        for batch in batches:
            for found in reader.of(utf8(batch, "text")):
                keys, again = found["keys"].view(np.int64), _again(found["uid"], seen)
                yield {
                    "uid": found["uid"],
                    "doc_id": batch.column("doc_id").take(pa.array(found["text"])),
                    "first": found["first"],
                    "words": found["words"],
                    **{c: pa.array(keys[:, i], mask=again) for i, c in enumerate(names)},
                }

    return materialize(map_batches(docs.select("doc_id", "text"), step, schema), "passages")


def _again(uids: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which of these are in ``seen``, or come a second time; the others join it."""
    if len(seen) >= MEMORY:
        seen.clear()
    out = np.ones(len(uids), bool)
    for i, uid in enumerate(uids.tolist()):
        if uid not in seen:
            seen.add(uid)
            out[i] = False
    return out


def representatives(found: DataFrame) -> DataFrame:
    """One occurrence of each paragraph, that in the smallest document: uid, d, first, words."""
    order = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    places = found.groupBy("uid").agg(
        F.min(order).alias("d"),
        F.min_by("first", order).alias("first"),
        F.min_by("words", order).alias("words"),
    )
    return materialize(places, "passages-places")


def bands(found: DataFrame) -> DataFrame:
    """Each paragraph of a band but the first: key, uid, low (the band's first), near (the neighbour), nth."""
    names = [f"k{i}" for i in range(BANDS)]
    # A paragraph comes once from each task that has it at most, and again from those whose memory was full.
    meeting = found.where("k0 IS NOT NULL").select("uid", F.explode(F.array(*names)).alias("key"))
    band = Window.partitionBy("key").orderBy("uid")
    met = meeting.select(
        "key",
        "uid",
        F.first("uid").over(band).alias("low"),
        F.lag("uid").over(band).alias("near"),
        F.dense_rank().over(band).alias("nth"),
    )
    return materialize(met.where("near <> uid"), "passages-bands")


def crowds(met: DataFrame) -> DataFrame:
    """key and uid of all paragraphs in bands of at least ``CROWD``."""
    full = met.where(F.col("nth") == CROWD)
    rest = met.select("key", "uid").join(full.select("key"), "key", "left_semi")
    return full.select("key", F.col("low").alias("uid")).union(rest)


def candidates(met: DataFrame, places: DataFrame) -> DataFrame:
    """Pairs (a, b) of different paragraphs in a band: with its first, and with the neighbour.

    Stretches that overlap each other in a document are the same text and no pair.
    """
    pairs = met.select("uid", F.explode(F.array("low", "near")).alias("other"))
    pairs = pairs.select(F.least("uid", "other").alias("a"), F.greatest("uid", "other").alias("b"))
    pairs = materialize(pairs.distinct(), "passages-met")
    pairs = pairs.join(places.toDF("a", "da", "fa", "wa"), "a")
    pairs = pairs.join(places.toDF("b", "db", "fb", "wb"), "b")
    overlap = F.expr("da = db AND fa < fb + wb AND fb < fa + wa")
    return pairs.where(~overlap).select("a", "b")


def mixed(crowd: DataFrame, classes: DataFrame) -> DataFrame:
    """key, uid and class of the paragraphs in bands that hold several classes."""
    placed = crowd.join(classes.withColumnRenamed("node", "uid"), "uid", "left")
    placed = placed.select("key", "uid", F.coalesce("component", "uid").alias("class"))
    placed = materialize(placed, "passages-crowds")
    several = placed.groupBy("key").agg(F.min("class").alias("l"), F.max("class").alias("h"))
    return placed.join(several.where("l < h").select("key"), "key", "left_semi")


def can_link(a: str, b: str, similarity: float) -> Column:
    """Whether two structs (class, size, parities, d, first, words) are of different classes and can be similar."""
    a, b = (lambda name, c=c: F.col(f"{c}.{name}") for c in (a, b))
    together = a("size") + b("size")
    differ = [F.bit_count(a("parities")[i].bitwiseXOR(b("parities")[i])) for i in range(BITS // 64)]
    overlap = (
        (a("d") == b("d"))
        & (a("first") < b("first") + b("words"))
        & (b("first") < a("first") + a("words"))
    )
    few = sum(differ[1:], differ[0]) <= together - 2 * _shared(together, similarity)
    return (a("class") != b("class")) & few & ~overlap


def _shared(together: Column, similarity: float) -> Column:
    """How many shingles two sets of so many together have to share."""
    return F.ceil(together * F.lit(similarity / (1 + similarity)) - F.lit(1e-9)).cast("int")


_WHO = ("uid", "class", "size", "parities", "d", "first", "words")


def neighbours(band: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different classes that follow each other in a band (``mixed``) in some order.

    The more minimum hashes two sets have in common, the nearer they are in an order by these.
    """
    rows = band.join(sets.drop("shingles"), "uid").select("key", "orders", F.struct(*_WHO).alias("one"))
    turns = [Window.partitionBy("key").orderBy(F.col("orders")[i], "one.uid") for i in range(TURNS)]
    rows = rows.select("one", F.array(*(F.lag("one").over(turn) for turn in turns)).alias("before"))
    pairs = rows.select("one", F.explode("before").alias("other")).where("other IS NOT NULL")
    pairs = pairs.where(can_link("one", "other", similarity)).select("one.uid", F.col("other.uid").alias("o"))
    return pairs.select(F.least("uid", "o").alias("a"), F.greatest("uid", "o").alias("b")).distinct()


def rare_shingles(band: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """shingle, at, keys and one (a struct) for the first shingles of each paragraph in ``band``.

    Shingles are ordered by the number of paragraphs that have them; ``at`` is a shingle's place. Two sets as
    similar as asked share one of the first ``size - ceil(similarity * size) + 1`` of either. Those that only one
    has pair nothing and are left out, but take their place.
    """
    who = band.groupBy("uid").agg(F.min("class").alias("class"), F.collect_set("key").alias("keys"))
    who = materialize(who.join(sets.drop("orders"), "uid"), "passages-members")
    each = who.select("uid", F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    ordered = each.join(often, "shingle").groupBy("uid")
    ordered = ordered.agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("order"))
    full = who.select("uid", "keys", F.struct(*_WHO).alias("one")).join(ordered, "uid")
    least = F.ceil(F.col("one.size") * F.lit(similarity) - F.lit(1e-9)).cast("int")
    alone = F.col("one.size") - F.size("order")
    rare = F.slice("order", F.lit(1), F.greatest(F.lit(0), F.col("one.size") - least + 1 - alone))
    rare = F.posexplode(rare["shingle"]).alias("at", "shingle")
    first = full.select("one", "keys", alone.alias("alone"), rare)
    return first.select("shingle", (F.col("at") + F.col("alone")).alias("at"), "keys", "one")


def remaining(band: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different classes in a band (``mixed``) that can be similar enough.

    Where a shingle is one of the first of many paragraphs, those of its most frequent class are
    paired only with the others.
    """
    first = materialize(rare_shingles(band, sets, similarity), "passages-rare")
    shared = first.groupBy("shingle", F.col("one.class").alias("class")).agg(F.count("*").alias("n"))
    shared = shared.groupBy("shingle").agg(
        F.max_by("class", F.struct("n", "class")).alias("main"), F.count("*").alias("classes")
    )
    shared = materialize(shared.where("classes > 1").drop("classes"), "passages-shared")
    first = first.join(shared, "shingle")
    other = first.where("one.class <> main").select(
        "shingle", F.col("at").alias("oat"), F.col("keys").alias("okeys"), F.col("one").alias("other")
    )
    need = _shared(F.col("one.size") + F.col("other.size"), similarity)
    # Before the first shingle that both have is none that they share.
    left = F.least(F.col("one.size") - F.col("at"), F.col("other.size") - F.col("oat"))
    # Of two that are both outside the main class, one order is enough.
    once = F.expr("one.class = main OR other.uid < one.uid")
    fits = (left >= need) & once & can_link("one", "other", similarity) & F.arrays_overlap("keys", "okeys")
    a, b = F.col("one.uid"), F.col("other.uid")
    pairs = other.join(first, "shingle").where(fits).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return materialize(pairs.distinct(), "passages-remaining")


def shingle_sets(docs: DataFrame, places: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted paragraphs, read again from one document each.

    uid, its place (d, first, words), shingles (hashes) and their number ``size``, ``parities`` and ``orders`` of them.
    """
    # Rows without id share a key with that number; the words tell whose paragraph it is.
    places = places.join(wanted, "uid", "left_semi")
    places = places.select("d", F.struct("uid", "first", "words").alias("at"))
    places = materialize(places.groupBy("d").agg(F.collect_list("at").alias("places")), "passages-at")
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)).cast("int")
    bits = np.zeros(FILTER_BITS, bool)
    bits[[r.bit for r in places.select(bit("d").alias("bit")).distinct().collect()]] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))
    texts = docs.select(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("d"), "text")
    texts = texts.withColumn("bit", bit("d"))

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        have = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            kept = batch.filter(pa.array(have[batch.column("bit").to_numpy()]))
            yield {"d": kept.column("d"), "text": kept.column("text")}

    fields = [T.StructField("d", T.LongType()), T.StructField("text", T.StringType())]
    texts = map_batches(texts, sieve, T.StructType(fields)).join(places, "d")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = _Hashes()
        found: list[tuple[dict, np.ndarray]] = []
        for batch in batches:
            lists = zip(batch.column("d").to_pylist(), batch.column("places").to_pylist(), strict=True)
            for text, (d, wanted_here) in zip(utf8(batch, "text"), lists, strict=True):
                words = (text or b"").lower().split()
                for p in wanted_here:
                    own = words[p["first"] : p["first"] + p["words"]]
                    # Of several rows with this doc_id only one may hold it.
                    if np.uint64(_name(own)).view(np.int64) == p["uid"]:
                        hashed = np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own))
                        found.append((p | {"d": d}, np.unique(_rolled(hashed, SHINGLE_WORDS))))
                    if len(found) >= BLOCK_SETS:
                        yield _described(found)
                        found = []
        if found:
            yield _described(found)

    long, longs = T.LongType(), T.ArrayType(T.LongType())
    kinds = {c: long for c in ("uid", "d", "first", "words", "size")}
    kinds |= {c: longs for c in ("shingles", "parities", "orders")}
    schema = T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])
    return map_batches(texts.select("d", "text", "places"), step, schema).dropDuplicates(["uid"])


def _described(found: list[tuple[dict, np.ndarray]]) -> dict[str, list]:
    """Columns of paragraphs (uid, d, first, words) and their distinct shingles, as ``shingle_sets`` returns them."""
    sizes = np.array([len(x) for _, x in found])
    every = np.concatenate([x for _, x in found])
    lists = lambda x: list(x.view(np.int64))
    return {
        **{c: [p[c] for p, _ in found] for c in ("uid", "d", "first", "words")},
        "size": sizes,
        "shingles": [x.view(np.int64) for _, x in found],
        "parities": lists(parities(every, sizes)),
        "orders": lists(orders(every, sizes)),
    }


def parities(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``BITS`` parities of each set; the sets, of these sizes, follow each other."""
    place = np.repeat(np.arange(len(sizes)) * BITS, sizes) + (shingles % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount(place, minlength=len(sizes) * BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64).reshape(len(sizes), BITS // 64)


def orders(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A number per set and turn: the last bytes of its minimum hashes, one after the other."""
    starts = np.cumsum(sizes) - sizes
    out = np.zeros((len(sizes), TURNS), np.uint64)
    for turn, hashes in enumerate(_TURN):
        for h in hashes:
            smallest = np.minimum.reduceat(shingles ^ h, starts)
            out[:, turn] = out[:, turn] << np.uint64(8) | smallest & np.uint64(255)
    return out


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) with at least this exact Jaccard similarity of shingles."""
    sets = sets.select("uid", "shingles")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    likeness = common / (F.size("sa") + F.size("sb") - common)
    return both.where(likeness >= similarity).select("a", "b")


def joined(classes: DataFrame, more: DataFrame) -> DataFrame:
    """The classes (node, component) after more links (a, b)."""
    # The links join whole classes, which are far fewer than their paragraphs.
    named = lambda c: classes.toDF(c, f"{c}_class")
    ends = more.join(named("a"), "a", "left").join(named("b"), "b", "left")
    ends = ends.select(F.coalesce("a_class", "a").alias("a"), F.coalesce("b_class", "b").alias("b"))
    ends = materialize(components(ends.distinct()), "passages-joined").toDF("component", "final")
    moved = classes.join(ends, "component", "left")
    moved = moved.select("node", F.coalesce("final", "component").alias("component"))
    single = ends.join(classes, ends["component"] == classes["node"], "left_anti")
    return moved.union(single.select(F.col("component").alias("node"), F.col("final").alias("component")))


def _linked(docs: DataFrame, found: DataFrame, similarity: float) -> tuple[DataFrame, ...]:
    """Links found by neighbours in bands, their components, and the links that join these."""
    met = bands(found)
    places = representatives(found)
    pairs = materialize(candidates(met, places), "passages-pairs")
    crowd = materialize(crowds(met), "passages-crowd")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("uid")).union(crowd.select("uid"))
    sets = materialize(shingle_sets(docs, places, wanted.distinct()), "passages-sets")
    near = materialize(similar(pairs, sets, similarity), "passages-near")
    classes = materialize(components(near), "passages-classes")
    close = materialize(neighbours(mixed(crowd, classes), sets, similarity), "passages-close")
    close = materialize(similar(close, sets, similarity), "passages-closer")
    classes = materialize(joined(classes, close), "passages-classes")
    others = remaining(mixed(crowd, classes), sets, similarity)
    joining = materialize(similar(others, sets, similarity), "passages-joining")
    return near.union(close), classes, joining


def links(docs: DataFrame, found: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Verified pairs (a, b) whose components are those of all similar pairs that meet in a band."""
    near, _, joining = _linked(docs, found, similarity)
    return near.union(joining)


def linked_classes(docs: DataFrame, found: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """node and component (its smallest node) of all linked paragraphs."""
    _, classes, joining = _linked(docs, found, similarity)
    return joined(classes, joining)


def duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Occurrences of paragraphs that stand in several documents.

    doc_id, first, words, class_id, keeper (the document that keeps it), removed.
    """
    found = paragraphs(docs)
    linked = materialize(linked_classes(docs, found, similarity), "passages-linked")
    places = found.select("uid", "doc_id", "first", "words")
    placed = places.join(linked.withColumnRenamed("node", "uid"), "uid", "left")
    placed = placed.withColumn("class_id", F.coalesce("component", "uid")).drop("component", "uid")
    placed = materialize(placed, "passages-placed")
    # Documents without id count as one more, larger than all others.
    several = placed.groupBy("class_id").agg(
        F.min("doc_id").alias("keeper"),
        F.max("doc_id").alias("last"),
        F.max(F.col("doc_id").isNull()).alias("nameless"),
    )
    several = several.where("keeper IS NOT NULL AND (keeper < last OR nameless)")
    several = materialize(several.drop("last", "nameless"), "passages-several")
    removed = F.col("doc_id").isNull() | (F.col("doc_id") != F.col("keeper"))
    return placed.join(several, "class_id").select(
        "doc_id", "first", "words", "class_id", "keeper", removed.alias("removed")
    )


def merged(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching word ranges (start, end) as one each."""
    out: list[list[int]] = []
    for start, end in sorted(places):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.StringType()),
    T.StructField("removed", T.StringType()),
    T.StructField("keepers", T.ArrayType(T.LongType())),
]


def by_document(found: DataFrame) -> DataFrame:
    """Per document with a shared passage: its passages and which of them go.

    doc_id, n_words and n_removed (words in shared and in removed passages), spans and removed
    (``start:end`` word ranges, comma-joined), keepers (the documents that keep what is removed here).
    """
    place = F.struct("first", "words", "keeper", "removed")
    per_doc = found.groupBy("doc_id").agg(F.collect_list(place).alias("places"))
    schema = T.StructType([found.schema["doc_id"], *RESULT])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns: dict[str, list] = {f.name: [] for f in RESULT}
            for places in batch.column("places").to_pylist():
                whole = merged([(p["first"], p["first"] + p["words"]) for p in places])
                gone = [p for p in places if p["removed"]]
                spans = merged([(p["first"], p["first"] + p["words"]) for p in gone])
                columns["n_words"].append(sum(b - a for a, b in whole))
                columns["n_removed"].append(sum(b - a for a, b in spans))
                columns["spans"].append(",".join(f"{a}:{b}" for a, b in whole))
                columns["removed"].append(",".join(f"{a}:{b}" for a, b in spans))
                columns["keepers"].append(sorted({p["keeper"] for p in gone}))
            yield {"doc_id": batch.column("doc_id"), **columns}

    return map_batches(per_doc, step, schema)
