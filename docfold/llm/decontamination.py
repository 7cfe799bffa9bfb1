"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The words of a text are its symbols. All windows of one length form a pattern set with a table of
shifts: the last ``BLOCK_WORDS`` words at a position say how far the search may jump, because no
window can end before. A shift of zero leads to the bucket of windows that end in this block; those with the hash of
the words at hand are compared with them directly. Shorter items are windows of their own length.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text (one item at least). Each block is
searched in all texts by one pass, and passes add to what earlier ones found, so neither the driver
nor a task ever holds more than one block; its tables are built once per worker process. An empty table of documents
gives no rows, very long texts are searched whole, and other columns may have any names. Null texts have no words; an item without words has no
window; an item without id hits words but names nothing; rows with equal item ids are one item.
Rows of documents are judged one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import map_batches
from docfold.session import materialize

WINDOW_WORDS = 10
BLOCK_WORDS = 2
BLOCK_BYTES = 8 << 20

_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: A-Z to a-z, every byte outside words to a space.
_FOLD = bytes(
    low if (low := c + 32 if 0x41 <= c <= 0x5A else c) in _WORD_BYTES else 0x20 for c in range(256)
)

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, letters a-z and everything beyond ASCII."""
    return (text or b"").translate(_FOLD).split()


class PatternSet:
    """Shift table and suffix buckets of windows that all have ``length`` words, as packed arrays.

    Both are addressed by a hash of a block of words. Blocks that share a place share the smaller shift, and windows that
    share a bucket are told apart by a hash of the whole window and then by their words.
    """

    def __init__(self, length: int):
        self.length = length
        self.block = min(BLOCK_WORDS, length)
        self.jump = min(length - self.block + 1, 255)
        self._blocks, self._shifts = array("q"), bytearray()
        self._starts, self._ends, self._whole = array("q"), array("q"), array("q")

    def add(self, words: list[bytes], first: int) -> None:
        """All windows of an item, whose first word is number ``first``."""
        length, block = self.length, self.block
        hashes = list(map(hash, zip(*(words[i:] for i in range(block)), strict=False)))
        self._blocks.extend(hashes)
        # Every place of an item but the first ones is the end of a window.
        self._shifts.extend(min(max(0, length - end), self.jump) for end in range(block, len(words) + 1))
        n = len(words) - length + 1
        self._starts.extend(range(first, first + n))
        self._ends.extend(hashes[length - block :])
        self._whole.extend(hash(b" ".join(words[i : i + length])) for i in range(n))

    def seal(self) -> PatternSet:
        bits = max(8, len(self._blocks).bit_length() + 2)
        self.mask, places = (1 << bits) - 1, np.frombuffer(self._blocks, np.int64)
        table = np.full(1 << bits, self.jump, np.uint8)
        np.minimum.at(table, places & self.mask, np.frombuffer(self._shifts, np.uint8))
        self.shift = table.tobytes()
        bits = max(8, len(self._starts).bit_length())
        self.bucket = (1 << bits) - 1
        buckets = np.frombuffer(self._ends, np.int64) & self.bucket
        whole = np.frombuffer(self._whole, np.int64)
        order = np.lexsort((whole, buckets))
        self.whole, self.starts = whole[order], np.frombuffer(self._starts, np.int64)[order]
        counts = np.bincount(buckets, minlength=self.bucket + 1)
        self.heads = np.concatenate([[0], np.cumsum(counts)])
        del self._blocks, self._shifts, self._starts, self._ends, self._whole
        return self

    def search(self, words: list[bytes]) -> Iterator[tuple[int, bytes, np.ndarray]]:
        """Start and text of every place that may be an occurrence, and the windows with the same hash."""
        shift, mask, heads, length, block = self.shift, self.mask, self.heads, self.length, self.block
        end, n = length, len(words)
        while end <= n:
            part = hash(tuple(words[end - block : end]))
            step = shift[part & mask]
            if step:
                end += step
                continue
            low, high = heads[part & self.bucket], heads[(part & self.bucket) + 1]
            if low < high:
                text = b" ".join(words[end - length : end])
                near, whole = self.whole[low:high], hash(text)
                low, high = low + near.searchsorted(whole), low + near.searchsorted(whole, "right")
                if low < high:
                    yield end - length, text, self.starts[low:high]
            end += 1


class Matcher:
    """Pattern sets for a block of items (item_id, text in UTF-8)."""

    def __init__(self, items: Iterable[tuple[int | None, bytes | None]], window: int):
        text, self.offsets = bytearray(), array("q")
        self.firsts, self.ids = array("q"), []
        by_length: dict[int, PatternSet] = {}
        for item, data in items:
            words = words_of(data)
            size = min(window, len(words))
            if not size:
                continue
            by_length.setdefault(size, PatternSet(size)).add(words, len(self.offsets))
            self.firsts.append(len(self.offsets))
            self.ids.append(item)
            for word in words:
                self.offsets.append(len(text))
                text += word + b" "
        self.offsets.append(len(text))
        self.text = bytes(text)
        self.sets = [by_length[k].seal() for k in sorted(by_length)]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Joined hit ranges of words (end exclusive), and the items that occur."""
        ranges, items = [], set()
        for patterns in self.sets:
            known: dict[bytes, bool] = {}
            for start, text, near in patterns.search(words):
                if text not in known:
                    same = [i for i in near.tolist() if self._is(i, patterns.length, text)]
                    known[text] = bool(same)
                    items.update(self.ids[bisect_right(self.firsts, i) - 1] for i in same)
                if known[text]:
                    ranges.append((start, start + patterns.length))
        return joined(ranges), items - {None}

    def _is(self, start: int, length: int, text: bytes) -> bool:
        """Direct comparison of the window at word number ``start``."""
        return self.text[self.offsets[start] : self.offsets[start + length] - 1] == text


_BUILT: dict[str, Matcher] = {}


def shared_matcher(name: str, items: Iterable[tuple], window: int) -> Matcher:
    """The matcher of a block, built once per worker process; the one before goes."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Matcher(items, window)
    return _BUILT[name]


def joined(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as one each, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """Items in lists of bounded size; there is always a list, if only an empty one."""
    size, block, any_yet = 0, [], False
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    for item, text in rows.where("text IS NOT NULL").toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            size, block, any_yet = 0, [], True
        block.append((item, bytes(text)))
        size += len(text)
    if block or not any_yet:
        yield block


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    columns: list[str],
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row``: the named columns; ``found``: number of words, hit ranges of words, items that occur."""
    texts = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"))
    passes = blocks(benchmark, block_bytes)
    block = next(passes)
    for following in passes:
        texts = materialize(_pass(texts, block, window, docs.columns), "decontamination")
        block = following
    return _pass(texts, block, window, columns)


def _pass(texts: DataFrame, block: list[tuple], window: int, columns: list[str]) -> DataFrame:
    items = texts.sparkSession.sparkContext.broadcast(block)
    name = uuid.uuid4().hex
    row = T.StructType([texts.schema["row"].dataType[c] for c in columns])
    schema = T.StructType([T.StructField("row", row), T.StructField("found", FOUND)])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        matcher = shared_matcher(name, items.value, window)
        for batch in batches:
            whole = batch.column("row")
            before = batch.column("found").to_pylist() if "found" in batch.schema.names else None
            found = []
            for i, text in enumerate(whole.field("text").cast(pa.binary()).to_pylist()):
                words = words_of(text)
                ranges, named = matcher.find(words)
                if before:
                    old = zip(before[i]["starts"], before[i]["ends"], strict=True)
                    ranges, named = joined([*ranges, *old]), named | set(before[i]["items"])
                starts, ends = [a for a, _ in ranges], [b for _, b in ranges]
                found.append(
                    {"n_words": len(words), "starts": starts, "ends": ends, "items": sorted(named)}
                )
            kept = [whole.field(c) for c in columns]
            yield {"row": pa.StructArray.from_arrays(kept, names=columns), "found": found}

    return map_batches(texts, step, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the hit ranges."""
    found = occurrences(
        docs.select("doc_id", "text"), benchmark, ["doc_id"], window, block_bytes
    )
    found = found.select("row.doc_id", "found.*")
    hit = F.aggregate(
        F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda n, r: n + r["ends"] - r["starts"]
    )
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
        "starts",
        "ends",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS
) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with all their columns."""
    found = occurrences(docs, benchmark, docs.columns, window)
    return found.where(F.size("found.starts") == 0).select("row.*")
