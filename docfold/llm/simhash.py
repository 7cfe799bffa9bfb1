"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius. Two fingerprints within the
radius have a variant in common, so one shuffle on variants brings them together; and since all
that share a variant are within the radius of each other, linking each of them to the smallest
of its variant loses no connection. A variant has at most as many fingerprints as the ball has
points, whatever the data, because equal fingerprints are merged first.

Null text is an empty text. A text without words has the fingerprint zero, linked like any other. Fewer words
than a shingle: the whole sequence is the shingle. Rows with equal ids are rows of their own;
a null id stays null and names no component unless nothing else is in it. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from docfold.llm.common import components, free_name, map_batches, utf8
from docfold.session import materialize

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
#: Shingles whose bits are counted at once, to bound memory on long texts.
BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of a text in UTF-8."""
    # bytes.lower changes A-Z only, and bytes.split splits at 0x20 and 0x09-0x0D.
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    n = max(1, len(words) - shingle_words + 1)
    hashed = (xxhash.xxh64_intdigest(s, SEED) for s in shingles)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, BLOCK):
        size = min(BLOCK, n - start)
        block = np.fromiter(itertools.islice(hashed, size), "<u8", size)
        bits = np.unpackbits(block.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, text: str = "text"
) -> DataFrame:
    """All columns named in ``docs`` but the text, and ``fp`` (signed 64 bits)."""
    rest = T.StructType([f for f in docs.schema if f.name != text])
    schema = T.StructType([*rest, T.StructField("fp", T.LongType())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = [fingerprint(x, shingle_words) for x in utf8(batch, text)]
            columns = {f.name: batch.column(f.name) for f in rest}
            yield columns | {"fp": np.array(values, np.uint64).view(np.int64)}

    return map_batches(docs, step, schema)


def classes(found: DataFrame, max_distance: int = MAX_DISTANCE, order: str = "doc_id") -> DataFrame:
    """For each distinct ``fp`` the smallest ``order`` value reachable by links: (fp, component_id)."""
    if max_distance % 2:
        raise ValueError("the radius has to be even: half of it is the ball that is emitted")
    masks = _masks(max_distance // 2)
    distinct = materialize(found.groupBy("fp").agg(F.min(order).alias("lowest")), "fingerprints")
    ball = F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("fp").bitwiseXOR(m))
    variants = distinct.select("fp", F.explode(ball).alias("variant"))
    meeting = variants.withColumn("first", F.min("fp").over(Window.partitionBy("variant")))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("first")))
    links = meeting.where("fp <> first").where(distance <= max_distance)
    linked = materialize(
        components(links.select(F.col("fp").alias("a"), F.col("first").alias("b"))), "components"
    )
    member = linked.join(distinct, linked.node == distinct.fp).select("fp", "component", "lowest")
    best = member.groupBy("component").agg(F.min("lowest").alias("reached"))
    reached = member.join(best, "component").select("fp", "reached")
    return distinct.join(reached, "fp", "left").select(
        "fp", F.coalesce("reached", "lowest").alias("component_id")
    )


def _masks(radius: int) -> list[int]:
    """All signed 64-bit values with at most ``radius`` bits set."""
    chosen = (c for r in range(radius + 1) for c in itertools.combinations(range(64), r))
    values = np.array([sum(1 << bit for bit in c) for c in chosen], np.uint64)
    return values.view(np.int64).tolist()


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    found = materialize(fingerprints(docs.select("doc_id", "text"), shingle_words), "simhash")
    # As a table, so that the join below has two shuffled sides and a hot fingerprint can be split.
    reached = materialize(classes(found, max_distance), "simhash-classes")
    return found.join(reached, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """One row of each near-duplicate class, with all columns of ``docs``.

    The row with the smallest doc_id stays, of several such rows any one; rows without id stay only
    if nothing else is in their class.
    """
    row = free_name(docs, "row")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.monotonically_increasing_id())
    whole = materialize(docs.withColumn(row, place), "simhash-docs")
    found = materialize(fingerprints(whole.select(row, "text"), shingle_words), "simhash")
    kept = classes(found, max_distance, order=row).select(F.col("component_id").alias(row))
    return whole.join(kept.distinct(), row, "left_semi").select(*docs.columns)
