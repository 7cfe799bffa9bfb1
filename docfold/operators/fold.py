"""Fold committed events into the current rows of every entity, set-based.

The order of events is ``seq``: for each row the newest event counts, and a root delete ends every
row of the entity that is older.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docfold.operators.skew import split_hot
from docfold.session import materialize
from docfold.spec import DOCUMENT_LIMIT_BYTES, DocumentSpec

# Room for what rendering adds to a row image: ISO dates and instants are longer than numbers.
ROW_OVERHEAD_BYTES = 64


def latest(events: DataFrame) -> DataFrame:
    """The newest action per row, and the newest removal of that row.

    Grouping is by row, with partial results before the shuffle, so neither an entity with very
    many rows nor a row with very many changes lands on one task.
    """
    return (
        events.filter("action <> 'none'")
        .groupBy("entity_id", "source", "row_id")
        .agg(
            F.max_by(F.struct("seq", "action", "image"), "seq").alias("w"),
            F.max(F.when(F.col("action") == "remove", F.col("seq"))).alias("removed_seq"),
        )
        .select("entity_id", "source", "row_id", "w.seq", "w.action", "w.image", "removed_seq")
    )


def lifetimes(rows: DataFrame, spec: DocumentSpec) -> DataFrame:
    """Per entity: last root delete, whether the root lives, and an upper bound of its bytes."""
    is_root = F.col("source") == spec.root
    is_put = F.col("action") == "put"
    size = F.when(is_put, F.octet_length("image") + ROW_OVERHEAD_BYTES)
    return rows.groupBy("entity_id").agg(
        F.coalesce(F.max(F.when(is_root, F.col("removed_seq"))), F.lit(-1)).alias("dead_before"),
        F.coalesce(F.max(F.when(is_root, is_put)), F.lit(False)).alias("root_lives"),
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
    )


def live_rows(
    rows: DataFrame, entities: DataFrame, limit: int = DOCUMENT_LIMIT_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """Current rows in long form: of entities that fit in one document, and of those that may not.

    Together the two frames are the whole state. ``rows`` is ``latest`` and ``entities`` is
    ``lifetimes``, both materialized. The second frame is null when every entity fits. Rows of
    entities without a root are kept; they show once the root arrives.
    """
    puts = rows.filter("action = 'put'").drop("action", "removed_seq")
    small, large = split_hot(puts, entities, "entity_id", "bytes", limit)
    alive = F.col("seq") > F.col("dead_before")
    return small.filter(alive), None if large is None else large.filter(alive)


def delete_markers(entities: DataFrame) -> DataFrame:
    """Entities whose root was deleted and has not come back."""
    return entities.filter("dead_before >= 0 and not root_lives").select("entity_id", "dead_before")


def in_ranges(
    rows: DataFrame, order: list[str], purpose: str, ranges: int | None = None
) -> DataFrame:
    """The rows as a written table whose column ``_p`` numbers ranges of (entity, order) of equal depth.

    The bounds come from the rows, so neither one entity nor a burst of positions makes a deep range. Rows with
    equal positions are told apart by the rest of ``order``.
    """
    n = [] if ranges is None else [ranges]
    ranged = rows.repartitionByRange(*n, "entity_id", *order)
    return materialize(ranged.withColumn("_p", F.spark_partition_id()), purpose)


def running(
    rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str, back: bool
) -> DataFrame:
    """Add a running value within the keys: the maximum up to here, or (``back``) the minimum after.

    ``rows`` come from ``in_ranges`` with this order: a short window inside every range, and one over the totals
    of a key's ranges, whose result is joined back. A key of any size stays distributed.
    """
    fold = F.min if back else F.max
    valued = rows.withColumn("_v", value)
    range_order = F.col("_p").desc() if back else F.col("_p")
    row_order = [F.col(c).desc() if back else F.col(c) for c in order]
    others = W.partitionBy(*keys).orderBy(range_order).rowsBetween(W.unboundedPreceding, -1)
    inside = (
        W.partitionBy(*keys, "_p")
        .orderBy(*row_order)
        .rowsBetween(W.unboundedPreceding, -1 if back else 0)
    )
    totals = valued.groupBy(*keys, "_p").agg(fold("_v").alias("_t"))
    carried = totals.select(*keys, "_p", fold("_t").over(others).alias("_carry"))
    combined = F.least("_run", "_carry") if back else F.greatest("_run", "_carry")
    return (
        valued.withColumn("_run", fold("_v").over(inside))
        .join(carried, [*keys, "_p"])
        .withColumn(name, combined)
        .drop("_v", "_run", "_carry")
    )


def row_history(events: DataFrame, spec: DocumentSpec, ranges: int | None = None) -> DataFrame:
    """Validity of every row version, ``[valid_from, valid_to)`` in log order.

    A version ends at the next event of its row or at the next root delete of its entity. The
    document of an entity at any point is the set of versions valid there.
    """
    keys = ["entity_id", "source", "row_id"]
    acts = events.filter("action <> 'none'").select(
        *keys, "seq", "action", "image"
    )
    order = ["seq", "source", "row_id"]
    acts = in_ranges(acts, order, "versions", ranges)
    root_end = F.when((F.col("source") == spec.root) & (F.col("action") == "remove"), F.col("seq"))
    ended = running(acts, ["entity_id"], order, root_end, "root_end", back=True)
    followed = running(ended, keys, order, F.col("seq"), "next_seq", back=True)
    return followed.filter("action = 'put'").select(
        *keys,
        F.col("seq").alias("valid_from"),
        F.least("next_seq", "root_end").alias("valid_to"),
        "image",
    )


def document_log(events: DataFrame, spec: DocumentSpec, ranges: int | None = None) -> DataFrame:
    """What each bundle makes the fold emit for its entity: a document, a marker or nothing."""
    is_root = F.col("source") == spec.root
    code = F.col("seq") * 2 + F.when(F.col("action") == "put", 1).otherwise(0)
    acts = is_root & (F.col("action") != "none")
    per_bundle = events.groupBy("bundle_id", "txn_id", "entity_id").agg(
        F.count("*").alias("n_events"),
        F.max("seq").alias("bundle_seq"),
        F.max("at").alias("at"),
        F.max(F.when(acts, code)).alias("root_code"),
        F.coalesce(F.max(acts & (F.col("action") == "remove")), F.lit(False)).alias("root_removed"),
    )
    order = ["bundle_seq", "bundle_id"]
    kept = in_ranges(per_bundle, order, "bundles", ranges)
    known = running(kept, ["entity_id"], order, F.col("root_code"), "known_root", back=False)
    lives = F.coalesce(F.pmod("known_root", F.lit(2)) == 1, F.lit(False))
    return known.withColumn(
        "emits", F.when(lives, "document").when(F.col("root_removed"), "marker").otherwise("nothing")
    ).drop("root_code", "known_root", "_p")


def as_of(bronze: DataFrame, seq: int) -> DataFrame:
    """The log as it was at ``seq``; fold it for a past state.

    Rows and END markers are cut alike, so a transaction that was not complete then shows nothing.
    """
    return bronze.filter(F.col("seq") <= seq)
