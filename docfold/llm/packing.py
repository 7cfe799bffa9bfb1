"""Best-fit packing of tokenized documents by the sum-of-squares rule.

A document's ids end with a separator; a document longer than a sequence is cut into pieces of full
length, of which the first one may be shorter. Pieces are placed longest first: among the open
sequences that have room, by residual gap, into one that makes the sum over all gaps of the squared
number of open sequences with that gap smallest (ties: the smallest gap). A new sequence is opened when none has room.

Pieces of one length are interchangeable, so only the number of pieces per length decides a layout. These
numbers are what the driver sees, whatever the size of the corpus. A layout is computed for a unit of at most
``UNIT_PIECES`` pieces with the corpus' mix of lengths and used as often as the corpus holds the
unit; what is left over (less than one unit's copies per length) is laid out again in the same
way. A piece finds its place by its length and its rank among the pieces of that length; ranks
come from counts per task, so no length meets in one task.

Null text is empty and makes a piece of the separator alone. Special token strings in a text are
ordinary text, or with ``added_tokens`` the tokenizer's added tokens (its own default, and that of the registered
queries). Rows with equal ids are packed each. An empty table gives no pieces. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from docfold.llm.common import map_batches
from docfold.session import materialize

CAPACITY = 1024
SEPARATOR = 2
UNIT_PIECES = 1 << 16
#: The ranks file of the vocabulary in ``TOKENIZER``: the same ids for ordinary text, several times faster.
VOCABULARY = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


class Encoder:
    """Ids of texts as the tokenizer gives them; the ranks file encodes what it can."""

    def __init__(self, vocabulary: str = VOCABULARY, added_tokens: bool = False):
        if vocabulary != VOCABULARY:
            raise ValueError(f"only {VOCABULARY} is known to have the ids of {TOKENIZER}")
        self.fast = encoding(public_tokenizers.path(vocabulary))
        self.whole = tokenizers.Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
        self.whole.encode_special_tokens = not added_tokens
        known = self.whole.get_added_tokens_decoder().values() if added_tokens else []
        self.added = [token.content for token in known]

    def __call__(self, text: str) -> np.ndarray:
        if not any(token in text for token in self.added):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # a very long run of blanks is too much for its pattern
                pass
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(size: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces."""
    first = (size - 1) % capacity + 1
    starts = [0, *range(first, size, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], size], strict=True)]


def tokenized(
    docs: DataFrame,
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
    vocabulary: str = VOCABULARY,
    added_tokens: bool = False,
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32 bits), part, nth.

    ``nth`` counts the pieces of one length in task ``part``. The result is a written table, so
    that these numbers stay as they are.
    """
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("nth", T.LongType()),
        ]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = Encoder(vocabulary, added_tokens)
        part, counts = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            columns = (batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            for doc_id, text in zip(*columns, strict=True):
                ids = np.append(encode(text or ""), separator).astype("<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    data = ids[start : start + length].tobytes()
                    rows.append((doc_id, piece, start, length, data, part, counts[length]))
                    counts[length] += 1
            for at in range(0, len(rows), 4096):
                values = zip(*rows[at : at + 4096], strict=True)
                yield dict(zip(schema.names, map(list, values), strict=True))

    return materialize(map_batches(docs.select("doc_id", "text"), step, schema), "packing-ids")


def lay_out(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of every piece, longest first, by the sum-of-squares rule; number of sequences.

    ``counts[n]`` is the number of pieces of length n; pieces of the same length follow each other.
    """
    sizes = np.repeat(np.arange(capacity, 0, -1), counts[:0:-1])
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    number = np.zeros(capacity + 1, np.int64)  # open sequences per gap; the gap 0 is not open
    sequences, offsets, used = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for i, size in enumerate(sizes):
        gaps = np.flatnonzero(number[size:capacity]) + size
        if len(gaps):
            # The change of the sum: one sequence leaves the gap, and one comes to the rest of it.
            change = 2 * (number[gaps - size] - number[gaps] + 1)
            change[0] -= gaps[0] == size
            gap = int(gaps[change.argmin()])
            number[gap] -= 1
            sequence = open_by_gap[gap].pop()
        else:
            gap, sequence, used = capacity, used, used + 1
        if gap > size:
            number[gap - size] += 1
            open_by_gap[gap - size].append(sequence)
        sequences[i], offsets[i] = sequence, capacity - gap
    return sequences, offsets, used


@dataclass
class Layer:
    """A layout that is used ``copies`` times; per length the first rank, pieces in a copy, first slot."""

    copies: int
    ranks_from: np.ndarray
    in_copy: np.ndarray
    slots_from: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray
    in_unit: int
    first_sequence: int


def plan(
    counts: np.ndarray, capacity: int = CAPACITY, unit_pieces: int = UNIT_PIECES
) -> list[Layer]:
    """Layers that place ``counts[n]`` pieces of each length n below the capacity."""
    left, done, layers, first = counts.copy(), np.zeros_like(counts), [], 0
    left[[0, capacity]] = 0  # full pieces are sequences of their own
    while left.sum():
        copies = max(1, int(left.sum()) // unit_pieces)
        in_copy = left // copies
        sequences, offsets, used = lay_out(in_copy, capacity)
        slots_from = np.zeros_like(in_copy)
        slots_from[capacity - 1 :: -1] = np.cumsum(in_copy[:0:-1])
        layers.append(
            Layer(copies, done.copy(), in_copy, slots_from, sequences, offsets, used, first)
        )
        first += used * copies
        done += in_copy * copies
        left -= in_copy * copies
    return layers


def place(
    pieces: DataFrame, capacity: int = CAPACITY, unit_pieces: int = UNIT_PIECES
) -> DataFrame:
    """``pieces`` (part, nth, length and any more) with sequence_id and offset in place of part and nth."""
    per_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    per_task = materialize(per_task, "packing-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # a row per length
        counts[length] = n
    layers = plan(counts, capacity, unit_pieces)
    before = Window.partitionBy("length").orderBy("part")
    ranks_from = per_task.select(
        "part", "length", (F.sum("n").over(before) - F.col("n")).alias("_from")
    )
    ranked = pieces.join(ranks_from, ["part", "length"])
    ranked = ranked.withColumn("_rank", F.col("_from") + F.col("nth"))
    ranked = ranked.drop("part", "nth", "_from")
    rest = [f for f in ranked.schema if f.name != "_rank"]
    schema = T.StructType(
        [*rest, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    shared = pieces.sparkSession.sparkContext.broadcast(layers)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        layers = shared.value
        full_from = sum(x.copies * x.in_unit for x in layers)
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = full_from + rank, np.zeros_like(rank)
            for x in layers:
                of, own = rank - x.ranks_from[length], x.in_copy[length]
                here = np.flatnonzero((of >= 0) & (of < own * x.copies) & (length < capacity))
                copy, slot = np.divmod(of[here], own[here])
                slot += x.slots_from[length[here]]
                sequence[here] = x.first_sequence + copy * x.in_unit + x.sequences[slot]
                offset[here] = x.offsets[slot]
            columns = {f.name: batch.column(f.name) for f in rest}
            yield columns | {"sequence_id": sequence, "offset": offset}

    return map_batches(ranked, step, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """Every piece of ``docs`` with its ids and its place."""
    return place(tokenized(docs, capacity, separator), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence: sequence_id, length, ids; a group holds no more than a sequence's ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    return whole.select("sequence_id", length.alias("length"), ids.alias("ids"))
