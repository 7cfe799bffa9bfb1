"""Joins and groupings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.spec import DOCUMENT_LIMIT_BYTES

# A key lighter than this many rows needs no splitting.
SLICE_ROWS = 262_144
# At most this many keys count as hot, so their list may be broadcast.
MAX_HOT_KEYS = 10_000


def hot_unit(facts: DataFrame, weight: str, unit: int) -> int | None:
    """The weight above which a key is hot, or null when no key is.

    ``facts`` is a materialized table with one row per key. The unit is raised to the share
    ``total / MAX_HOT_KEYS`` when needed; fewer than ``MAX_HOT_KEYS`` keys can be above it.
    """
    total, heavy = facts.agg(
        F.sum(weight), F.count_if(F.col(weight) > unit)
    ).first()
    if not heavy:
        return None
    return max(unit, math.ceil(total / MAX_HOT_KEYS)) if heavy > MAX_HOT_KEYS else unit


def attach(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    weight: str,
    salt: list[str],
    unit: int = SLICE_ROWS,
) -> DataFrame:
    """Inner join of ``rows`` with materialized one-row-per-key ``facts``.

    Without hot keys this is a plain join. Hot keys are cut into slices: their rows get a slice
    number from the salt columns and their facts are repeated once per slice.
    """
    limit = hot_unit(facts, weight, unit)
    if limit is None:
        return rows.join(facts, key)
    sliced = facts.withColumn(
        "_n", F.greatest(F.lit(1), F.ceil(F.col(weight) / F.lit(limit))).cast("int")
    )
    hot = sliced.filter("_n > 1").select(key, "_n")
    salted = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_slice", F.pmod(F.xxhash64(*salt), F.coalesce("_n", F.lit(1))).cast("int"))
        .drop("_n")
    )
    spread = sliced.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return salted.join(spread.drop("_n"), [key, "_slice"]).drop("_slice")


def split_hot(
    rows: DataFrame, facts: DataFrame, key: str, weight: str, limit: int = DOCUMENT_LIMIT_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys within the limit joined with their facts, and the same for the keys above it.

    Groups of the first frame are safe to collect: each is within the limit. Rows of the second
    must stay in long form; it is null when no key is above the limit.
    """
    heavy = facts.filter(F.col(weight) > limit)
    n_heavy = heavy.count()
    if n_heavy == 0:
        return rows.join(facts, key), None
    within = facts.filter(F.col(weight) <= limit)
    if n_heavy > MAX_HOT_KEYS:
        # Too many to broadcast: the list is joined by shuffle, with skewed partitions split by AQE.
        return rows.join(within, key), attach(rows, heavy, key, weight, ["row_id"], limit)
    listed = F.broadcast(heavy)
    light = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return light.join(within, key), rows.join(listed, key)


def sized(rows: DataFrame, key: str, bytes_column: str) -> DataFrame:
    """Rows and bytes per key; partial sums are made before the shuffle."""
    return rows.groupBy(key).agg(
        F.count("*").alias("n_rows"), F.sum(bytes_column).alias("total_bytes")
    )
