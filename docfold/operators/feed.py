"""Change feeds of the source and of the replica."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.operators.routing import with_ids
from docfold.operators.skew import attach
from docfold.session import materialize
from docfold.spec import DocumentSpec

# Operation names of a notification.
OPERATIONS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE"}


def notifications(rows: DataFrame, spec: DocumentSpec) -> DataFrame:
    """One notification per root change: ``operation, id, customer_number, occurred_at``.

    Snapshot reads are no changes. Works on a batch and on a stream.
    """
    number = "customer_number string"
    kind = F.col("op")
    operation = F.lit("change")
    for op, name in OPERATIONS.items():
        operation = F.when(kind == op, name).otherwise(operation)
    changed = rows.filter((F.col("source") == spec.root) & (kind != "r"))
    return with_ids(changed, spec).select(
        operation.alias("operation"),
        F.coalesce(f"after_ids.{spec.root_key}", f"before_ids.{spec.root_key}").alias("id"),
        F.coalesce(
            F.from_json("after", number)["customer_number"],
            F.from_json("before", number)["customer_number"],
        ).alias("customer_number"),
        F.col("at").alias("occurred_at"),
        "seq",
    )


def replica_changes(outputs: DataFrame, key: str, order: str) -> DataFrame:
    """Kind of every stored output: the first one of an id inserts, later ones replace."""
    kept = materialize(outputs, "outputs")
    firsts = kept.groupBy(key).agg(F.min(order).alias("first_order"), F.count("*").alias("n_out"))
    joined = attach(kept, materialize(firsts, "firsts"), key, "n_out", [order])
    kind = F.when(F.col(order) == F.col("first_order"), "insert").otherwise("replace")
    return joined.withColumn("operation", kind).drop("first_order", "n_out")


def combined(source_feed: DataFrame, replica_feed: DataFrame) -> DataFrame:
    """Both feeds as ``feed, operation, id, customer_number, at``."""
    left = source_feed.select(
        F.lit("source").alias("feed"),
        F.coalesce("operation", F.lit("change")).alias("operation"),
        "id",
        "customer_number",
        F.col("occurred_at").alias("at"),
    )
    right = replica_feed.select(
        F.lit("replica").alias("feed"),
        "operation",
        "id",
        F.lit(None).cast("string").alias("customer_number"),
        "at",
    )
    return left.unionByName(right)


def latest_per_feed(feed: DataFrame) -> DataFrame:
    """The newest event of each feed, and of both (``any``); ties by id, then operation."""
    newest = F.max_by(F.struct("operation", "id", "at"), F.struct("at", "id", "operation"))
    per_feed = feed.groupBy("feed").agg(newest.alias("w"))
    overall = feed.agg(newest.alias("w")).select(F.lit("any").alias("feed"), "w")
    return per_feed.unionByName(overall).select("feed", "w.operation", "w.id", "w.at")
