"""Queries over the change log: routing, transactions, bundles, fold, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.operators import assembly, documents, engine, fold, history, routing
from docfold.plans import mapping
from docfold.session import materialize
from docfold.spec import CUSTOMER_SPEC as SPEC


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(routing.decode(mapping.change_log(spark, sf_dir), SPEC), "decoded")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.row_events(_decoded(spark, sf_dir))


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(spark, sf_dir)
    return assembly.progress(routing.row_events(decoded), routing.marker_events(decoded))


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.actions(mapping.change_log(spark, sf_dir), SPEC)


def txn_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir).select("source", "seq", "txn_id", "routing_key")


def affected_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.affected(_rows(spark, sf_dir), SPEC).select(
        "seq", "pos", "entity_id", "source", "row_id", "action"
    )


def transaction_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _progress(spark, sf_dir).select("txn_id", "seen", "expected", "status")


def complete_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_entity = assembly.bundles(_actions(spark, sf_dir).filter("txn_id is not null"))
    return per_entity.groupBy("txn_id").agg(
        F.count("*").alias("n_entities"),
        F.sum("n_events").alias("n_bundle_events"),
        F.min("first_seq").alias("first_seq"),
    )


def stalled_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2030-01-01 00:00:00").cast("timestamp")
    return assembly.stalled(_progress(spark, sf_dir), now).select(
        "txn_id", "seen", "expected", "status", "age_seconds"
    )


def customer_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.bundles(_actions(spark, sf_dir).filter("txn_id is not null")).drop("bundle_id")


def bundle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir).select("bundle_id", "entity_id", "seq", "source", "action")


def passthrough_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).filter("txn_id is null")
    return assembly.bundle_events(rows, SPEC).select("bundle_id", "entity_id", "seq", "source")


def document_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.document_log(_actions(spark, sf_dir), SPEC).select(
        "bundle_id", "entity_id", "n_events", "bundle_seq", "emits"
    )


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.latest(_actions(spark, sf_dir)).select(
        "entity_id", "source", "row_id", "seq", "action", "removed_seq"
    )


def live_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = engine.state_of(_actions(spark, sf_dir), SPEC)
    return state.live.filter(F.col("source") != SPEC.root).select(
        "entity_id", "source", "row_id", "seq", "root_lives"
    )


def moved_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _actions(spark, sf_dir).filter(F.col("pos") == 1)
    return both.select("seq", "source", "row_id", F.col("entity_id").alias("left_entity"))


def row_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.row_history(_actions(spark, sf_dir), SPEC).drop("image")


def flat_outputs(outputs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Outputs as scalar columns, so that they can be compared with SQL."""
    doc = F.col("document")
    addresses = F.transform(
        doc["addresses"], lambda a: F.concat_ws(":", a["type"], a["line1"], a["validFrom"])
    )
    contacts = F.transform(
        doc["contacts"],
        lambda c: F.concat_ws(":", c["type"], c["value"], c["isPrimary"].cast("string")),
    )
    return outputs.select(
        *(keep or []),
        "_id",
        "deleted",
        doc["customer_number"].alias("customer_number"),
        doc["first_name"].alias("first_name"),
        doc["status"].alias("status"),
        doc["date_of_birth"].alias("date_of_birth"),
        doc["profile"]["preferredLanguage"].alias("preferred_language"),
        doc["profile"]["annualIncome"].alias("annual_income"),
        F.array_join(addresses, ",").alias("addresses"),
        F.array_join(contacts, ",").alias("contacts"),
        doc["preferences"]["marketingEmailOptIn"].alias("email_opt_in"),
        doc["preferences"]["notificationChannels"].alias("channels"),
        doc["created_at"].alias("created_at"),
        doc["updated_at"].alias("updated_at"),
    )


def final_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_outputs(engine.final_outputs(mapping.change_log(spark, sf_dir), SPEC))


def documents_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = mapping.table(spark, sf_dir, "events").agg((F.max("event_id") / 2)).scalar()
    return flat_outputs(engine.final_outputs(fold.as_of(mapping.change_log(spark, sf_dir), half), SPEC))


def document_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history.document_history(_actions(spark, sf_dir), SPEC)
    return flat_outputs(found, ["bundle_id", "bundle_seq"])


def delete_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fold.latest(_actions(spark, sf_dir))
    return fold.delete_markers(fold.lifetimes(rows, SPEC)).select(
        F.col("entity_id").alias("_id"), "dead_before"
    )


def document_updated_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = engine.state_of(_actions(spark, sf_dir), SPEC)
    return (
        state.live.filter("root_lives")
        .groupBy("entity_id")
        .agg(F.max(documents.updated_at(F.col("image"))).alias("at"))
        .select("entity_id", F.unix_millis("at").alias("updated_millis"))
    )


QUERIES = {
    "txn_routing": txn_routing,
    "affected_customers": affected_customers,
    "transaction_progress": transaction_progress,
    "complete_transactions": complete_transactions,
    "stalled_transactions": stalled_transactions,
    "customer_bundles": customer_bundles,
    "bundle_events": bundle_events,
    "passthrough_bundles": passthrough_bundles,
    "document_log": document_log,
    "latest_rows": latest_rows,
    "live_children": live_children,
    "moved_children": moved_children,
    "row_history": row_history,
    "final_documents": final_documents,
    "documents_as_of": documents_as_of,
    "document_history": document_history,
    "delete_markers": delete_markers,
    "document_updated_at": document_updated_at,
}
