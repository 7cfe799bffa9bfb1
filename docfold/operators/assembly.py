"""Transactions: count their rows, hold them until complete, split them into entity bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.operators import routing
from docfold.operators.skew import SLICE_ROWS, attach
from docfold.session import materialize
from docfold.spec import DocumentSpec


def progress(rows: DataFrame, markers: DataFrame) -> DataFrame:
    """Per transaction: rows seen, rows expected, and whether it may be published.

    A transaction is complete when an END marker is there and both counts are equal. The rule is
    applied to all rows known, so surplus rows keep a transaction open instead of being cut off at
    the moment of equality; they show up here as ``surplus``.
    """
    seen = (
        rows.filter(F.col("txn_id").isNotNull())
        .groupBy("txn_id")
        .agg(
            F.count("*").alias("seen"),
            F.min("seq").alias("first_seq"),
            F.max("seq").alias("last_seq"),
            F.min("at").alias("first_at"),
        )
    )
    ends = (
        markers.filter((F.col("status") == "END") & F.col("txn_id").isNotNull())
        .withColumn("event_count", F.coalesce("event_count", F.lit(-1)))
        .groupBy("txn_id")
        .agg(F.max_by("event_count", "seq").alias("expected"))
    )
    status = (
        F.when(F.col("expected").isNull(), "open")
        .when(F.col("expected") < 0, "no_count")
        .when(F.col("seen") == F.col("expected"), "complete")
        .when(F.col("seen") < F.col("expected"), "short")
        .otherwise("surplus")
    )
    return (
        seen.join(ends, "txn_id", "full_outer")
        .withColumn("seen", F.coalesce("seen", F.lit(0)))
        .withColumn("status", status)
    )


def stalled(transactions: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Transactions that still wait, with their age when an instant is given."""
    waiting = transactions.filter("status <> 'complete'")
    if as_of is not None:
        waiting = waiting.withColumn(
            "age_seconds", F.unix_seconds(as_of) - F.unix_seconds("first_at")
        )
    return waiting


def committed(rows: DataFrame, transactions: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rows that may be applied: those of complete transactions and those without one.

    ``transactions`` is a materialized ``progress``; its counts tell which transactions are so
    large that their rows have to be spread.
    """
    complete = transactions.filter("status = 'complete'").select("txn_id", "seen")
    gated = attach(
        rows.filter(F.col("txn_id").isNotNull()), complete, "txn_id", "seen", ["seq"], slice_rows
    )
    return gated.select(*rows.columns).unionByName(rows.filter(F.col("txn_id").isNull()))


def actions(
    bronze: DataFrame, spec: DocumentSpec, slice_rows: int = SLICE_ROWS, strict: bool = False
) -> DataFrame:
    """Bundle events in long form, one row per committed event and affected entity."""
    decoded = materialize(routing.decode(bronze, spec, strict), "decoded")
    rows = routing.row_events(decoded)
    transactions = materialize(progress(rows, routing.marker_events(decoded)), "progress")
    return bundle_events(committed(rows, transactions, slice_rows), spec)


def bundle_events(rows: DataFrame, spec: DocumentSpec) -> DataFrame:
    """Committed rows split by affected entity.

    Adds ``bundle_id``: the transaction, or the row itself when it has none. A row is named by its
    position, table and id, because all rows of a snapshot have one position. Long form keeps a
    transaction of any size spread over tasks; the order inside a bundle is ``seq``.
    """
    row = F.concat_ws(":", F.lit("row"), "seq", "source", F.coalesce("row_id", F.lit("")))
    bundle = F.coalesce(F.concat(F.lit("txn:"), "txn_id"), row)
    return routing.affected(rows, spec).withColumn("bundle_id", bundle)


def bundles(events: DataFrame) -> DataFrame:
    """One row per (bundle, entity): size, first and last event and the effect on the root.

    ``first_seq`` gives the first-seen order of entities within a transaction.
    """
    return events.groupBy("bundle_id", "txn_id", "entity_id").agg(
        F.count("*").alias("n_events"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("bundle_seq"),
    )
