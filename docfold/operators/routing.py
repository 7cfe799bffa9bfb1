"""Routing: decode log records, find their transaction and the entities they affect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.functions.values import computed_once, json_object, text, whole_number
from docfold.spec import MARKER_SOURCE, DocumentSpec

EVENT = (
    "op string, before string, after string, transaction struct<id: string>,"
    " status string, id string, event_count string, _bad string"
)


def normalized_transaction(raw: Column) -> Column:
    """The text before the first colon; rows and END of one transaction differ only after it."""
    return F.substring_index(text(raw), ":", 1)


def decode(bronze: DataFrame, spec: DocumentSpec, strict: bool = False) -> DataFrame:
    """Log records with their JSON read once: row events, markers and malformed records.

    Images stay JSON text (object or null) and are read fully only for the rows that win; ``with_ids``
    takes their ids out. Records without a value are skipped, and ``malformed`` marks values
    that are no JSON object and records without source or position; ``strict`` fails on the former. Materialize the result: it is read
    more than once.
    """
    options = {"mode": "FAILFAST"} if strict else {"columnNameOfCorruptRecord": "_bad"}
    event = F.from_json("value", EVENT, options)
    is_marker = F.col("source") == MARKER_SOURCE
    raw = F.when(is_marker, F.col("event.id")).otherwise(F.col("event.transaction.id"))
    before, after = json_object(F.col("event.before")), json_object(F.col("event.after"))
    bad = json_object(F.col("value")).isNull() | F.col("event._bad").isNotNull()
    bad = bad | F.col("source").isNull() | F.col("seq").isNull()
    fallback = F.concat_ws(":", F.lit("snapshot"), "source", F.coalesce("key", F.lit("null")))
    return (
        computed_once(bronze.filter(F.col("value").isNotNull()), {"event": event})
        .select(
            "source",
            "key",
            "seq",
            "at",
            F.coalesce(is_marker, F.lit(False)).alias("is_marker"),
            bad.alias("malformed"),
            F.col("event.op").alias("op"),
            F.col("event.status").alias("status"),
            whole_number(F.col("event.event_count")).alias("event_count"),
            before.alias("before"),
            after.alias("after"),
            normalized_transaction(raw).alias("txn_text"),
            F.when(bad, F.col("value")).alias("bad_value"),
        )
        .withColumn("txn_id", text(F.col("txn_text")))
        .withColumn("routing_key", F.coalesce("txn_text", fallback))
        .drop("txn_text")
    )


def with_ids(rows: DataFrame, spec: DocumentSpec) -> DataFrame:
    """Row events with the ids their images and their key name, read once and where they are needed."""
    ids = f"{spec.row_key} string, {spec.owner_key} string"
    texts = {"after_ids": "after", "before_ids": "before", "key_ids": "key"}
    return computed_once(rows, {name: F.from_json(text_, ids) for name, text_ in texts.items()})


def row_events(decoded: DataFrame) -> DataFrame:
    """The row events of a decoded log."""
    return decoded.filter("not is_marker and not malformed").drop(
        "is_marker", "malformed", "bad_value", "status", "event_count"
    )


def marker_events(decoded: DataFrame) -> DataFrame:
    """The transaction markers of a decoded log."""
    return decoded.filter("is_marker and not malformed").select(
        "txn_id", "status", "event_count", "seq", "at", "routing_key"
    )


def malformed(decoded: DataFrame) -> DataFrame:
    """Records without source or position, or whose value is no JSON object, for the dead letters."""
    error = (
        F.when(F.col("source").isNull(), "record has no source")
        .when(json_object(F.col("bad_value")).isNotNull() & F.col("seq").isNull(), "no log position")
        .otherwise("value is no JSON object")
    )
    return decoded.filter("malformed").select(
        "source", "key", "seq", "at", "bad_value", error.alias("error")
    )


def affected(rows: DataFrame, spec: DocumentSpec) -> DataFrame:
    """One row per event and affected entity, with what the event does to that entity.

    Adds ``pos`` (0 for the first entity seen), ``entity_id``, ``row_id`` and ``action``: ``put``,
    ``remove`` or ``none``. Events of unknown tables are counted in transactions and do nothing.
    """
    is_root = F.col("source") == spec.root
    is_many = F.col("source").isin(*[c.table for c in spec.collections])
    is_one = F.col("source").isin(*[c.table for c in spec.singletons])

    def owner(image: str) -> Column:
        root_id = F.coalesce(f"{image}.{spec.root_key}", f"key_ids.{spec.root_key}")
        owner_id = F.coalesce(f"{image}.{spec.owner_key}", f"key_ids.{spec.owner_key}")
        return F.when(is_root, root_id).otherwise(owner_id)

    deleted = F.coalesce(F.col("op") == "d", F.lit(False)) | F.col("after").isNull()
    own_row = F.coalesce(
        F.when(deleted, F.col(f"before_ids.{spec.row_key}")).otherwise(
            F.col(f"after_ids.{spec.row_key}")
        ),
        F.col(f"key_ids.{spec.row_key}"),
    )
    me = F.col("entity_id")
    # A collection row names its owner in its images; the key fallback is for the other tables.
    after_owner = F.when(is_many, F.col(f"after_ids.{spec.owner_key}")).otherwise(
        owner("after_ids")
    )
    before_owner = F.when(is_many, F.col(f"before_ids.{spec.owner_key}")).otherwise(
        owner("before_ids")
    )
    root_action = (
        F.when(~own_row.eqNullSafe(me), "none").when(deleted, "remove").otherwise("put")
    )
    child_action = (
        F.when(is_many & own_row.isNull(), "none")
        .when((after_owner == me) & ~deleted, "put")
        .when(before_owner == me, "remove")
        .otherwise("none")
    )
    action = F.when(is_root, root_action).when(is_many | is_one, child_action).otherwise("none")
    owners = F.array_distinct(F.array_compact(F.array(owner("after_ids"), owner("before_ids"))))
    return with_ids(rows, spec).select("*", F.posexplode(owners).alias("pos", "entity_id")).select(
        "seq",
        "at",
        "source",
        "txn_id",
        "pos",
        "entity_id",
        F.when(is_many, own_row).otherwise(me).alias("row_id"),
        action.alias("action"),
        F.when(action == "put", F.col("after")).alias("image"),
    )
