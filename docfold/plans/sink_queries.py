"""Queries over sinks, feeds, parity and workload, and the streaming form of the fold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.operators import assembly, documents, engine, feed, fold, metrics, parity, relational, routing
from docfold.plans import mapping
from docfold.plans.log_queries import flat_outputs
from docfold.plans.table_queries import snapshot_outputs
from docfold.session import materialize, work_folder
from docfold.sources.changelog import read_log
from docfold.spec import CUSTOMER_SPEC as SPEC
from docfold.spec import MARKER_SOURCE
from docfold.streaming import feeds, pipeline, rebuild, sinks


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(routing.decode(mapping.change_log(spark, sf_dir), SPEC), "decoded")


def _emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = assembly.actions(mapping.change_log(spark, sf_dir), SPEC)
    return fold.document_log(events, SPEC).filter("emits <> 'nothing'")


def document_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = engine.final_outputs(mapping.change_log(spark, sf_dir), SPEC)
    return outputs.select("_id", documents.document_json(SPEC).alias("json"))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink with a small document limit: what is stored and what is set aside."""
    outputs = engine.final_outputs(mapping.change_log(spark, sf_dir), SPEC)
    return sinks.judged(outputs, SPEC, limit=700).select("_id", "outcome", "error", "json_bytes")


def sink_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _emitted(spark, sf_dir).select(
        F.col("entity_id").alias("_id"), "emits", "bundle_id", "bundle_seq"
    )
    return sinks.newest_per_id(versions, "bundle_seq")


def final_documents_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log in two parts through the streaming query, each a run from the checkpoint.

    Rows of one transaction fall in both parts; the markers come with the second.
    """
    base = work_folder(spark, "stream")
    log = mapping.change_log(spark, sf_dir)
    early = (F.col("source") != MARKER_SOURCE) & (F.col("seq") % 2 == 0)
    for part in (log.filter(early), log.filter(~early)):
        part.write.mode("append").parquet(f"{base}/log")
        query = pipeline.start(
            read_log(spark, f"{base}/log", streaming=True),
            SPEC,
            f"{base}/sink",
            f"{base}/checkpoint",
            available_now=True,
        )
        query.awaitTermination()
    return flat_outputs(sinks.replica(spark, f"{base}/sink"))


def rebuilt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The early part of the log by backfill, the rest by a stream that goes on from its state."""
    base = work_folder(spark, "rebuild")
    log = mapping.change_log(spark, sf_dir)
    early = (F.col("source") != MARKER_SOURCE) & (F.col("seq") % 2 == 0)
    log.filter(early).write.parquet(f"{base}/log")
    rebuild.backfill(rebuild.read_files(spark, f"{base}/log"), SPEC, f"{base}/sink", f"{base}/seed")
    log.filter(~early).write.mode("append").parquet(f"{base}/log")
    found = rebuild.read_files(spark, f"{base}/log", streaming=True)
    query = pipeline.start(
        rebuild.remaining(found, f"{base}/seed"),
        SPEC,
        f"{base}/sink",
        f"{base}/checkpoint",
        available_now=True,
        seed=f"{base}/seed",
    )
    query.awaitTermination()
    return flat_outputs(sinks.replica(spark, f"{base}/sink"))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir).withColumn("at", F.unix_millis("at"))


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = feed.notifications(routing.row_events(_decoded(spark, sf_dir)), SPEC)
    stored = _emitted(spark, sf_dir).select(F.col("entity_id").alias("id"), "bundle_seq", "at")
    return feed.combined(source, feed.replica_changes(stored, "id", "bundle_seq"))


def change_feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as one stream over three runs, the newest batch of the sink replayed between two of them."""
    base = work_folder(spark, "feeds")
    log = materialize(mapping.change_log(spark, sf_dir), "log")
    stored = materialize(
        fold.document_log(assembly.actions(log, SPEC), SPEC)
        .filter("emits <> 'nothing'")
        .select(
            F.col("entity_id").alias("_id"),
            (F.col("emits") == "marker").alias("deleted"),
            F.col("bundle_seq").alias("version"),
            F.col("at").alias("committed_at"),
            F.lit("stored").alias("outcome"),
            F.expr("bundle_seq div 4000").alias("step"),
            sinks.bucket_of(F.col("entity_id")).alias("bucket"),
        ),
        "stored",
    )
    for run in range(3):
        part = F.least(F.expr("seq div 4000"), F.lit(2)) == run
        log.filter(part).write.mode("append").parquet(f"{base}/log")
        # Batches up to the one before come again.
        outputs = stored.withColumn("batch_id", F.least("step", F.lit(2)).cast("bigint")).drop("step")
        again = outputs.filter(F.col("batch_id").between(max(0, run - 1), run))
        again.repartition("batch_id", "bucket").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("outcome", "batch_id", "bucket").parquet(f"{base}/sink/log")
        feeds.start(
            read_log(spark, f"{base}/log", streaming=True),
            SPEC,
            f"{base}/sink",
            f"{base}/feed",
            f"{base}/checkpoint",
            available_now=True,
        ).awaitTermination()
    tables = (feeds.ordered, feeds.late, feeds.waiting)
    both = [t(spark, f"{base}/feed").select("feed", "operation", "id", "customer_number", "at") for t in tables]
    return both[0].unionByName(both[1]).unionByName(both[2]).withColumn("at", F.unix_millis("at"))


def latest_feed_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = feed.latest_per_feed(materialize(_feed(spark, sf_dir), "feed"))
    return latest.withColumn("at", F.unix_millis("at"))


def _faulty(replica: DataFrame) -> DataFrame:
    """A replica with faults put in by id.

    Every field has faults of its own; some documents are missing, and some are there twice.
    """
    replica = materialize(replica, "replica")
    fields = [c for c in replica.columns if c != "id"]
    faulty = replica.filter("id % 101 <> 0").select(
        "id",
        *[
            F.when(F.col("id") % 41 == i, F.lit("fault")).otherwise(F.col(c)).alias(c)
            for i, c in enumerate(fields)
        ],
    )
    extra = replica.filter("id % 109 = 0").withColumn("id", F.col("id") + 1_000_000_000)
    return faulty.unionByName(extra)


def _canonical(spark: SparkSession, sf_dir: str, outputs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Expected documents from the tables, and the replica with its faults: of ``outputs``, where a query has them."""
    tables = mapping.base_tables(spark, sf_dir)
    expected = parity.canonical_tables(relational.relational_documents(tables, SPEC), SPEC)
    outputs = snapshot_outputs(spark, sf_dir) if outputs is None else outputs
    return expected, _faulty(parity.canonical_store(outputs, SPEC))


def count_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts need the documents' ids and no field of them, so only these are written."""
    replica = _faulty(parity.canonical_store(snapshot_outputs(spark, sf_dir), SPEC).select("id"))
    return parity.count_parity(mapping.table(spark, sf_dir, "customer"), replica)


def field_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, replica = _canonical(spark, sf_dir)
    return parity.field_diff(expected, replica, "id")


def stale_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = materialize(snapshot_outputs(spark, sf_dir), "snapshot")
    expected, replica = _canonical(spark, sf_dir, outputs)
    differences = parity.field_diff(expected, replica, "id")
    customers = mapping.base_tables(spark, sf_dir)["customers"]
    as_of = F.lit("2024-01-25 00:00:00").cast("timestamp")
    doc = F.col("document")
    stored = outputs.select(
        doc["id"].alias("id"), doc["updated_at"].cast("timestamp").alias("updated_at")
    )
    # The extra documents of the replica are copies under another id.
    extra = stored.filter("id % 109 = 0").withColumn("id", F.col("id") + 1_000_000_000)
    stored = stored.unionByName(extra)
    return parity.stale(differences, customers, stored, "id", "updated_at", as_of, 10 * 86_400)


def sampled_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, replica = _canonical(spark, sf_dir)
    return parity.field_diff(
        parity.sample(expected, "id", 7), parity.sample(replica, "id", 7), "id"
    )


def repair_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = materialize(snapshot_outputs(spark, sf_dir), "snapshot")
    expected, replica = _canonical(spark, sf_dir, outputs)
    repairs = parity.repair_list(parity.field_diff(expected, replica, "id"), "id")
    outputs = parity.repair_outputs(outputs, repairs)
    return outputs.select("_id", "deleted", F.col("document.status").alias("status"))


def replication_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags read from the sink's files, which a write with a fixed clock has made."""
    sink = work_folder(spark, "lag-sink")
    events = assembly.actions(mapping.change_log(spark, sf_dir), SPEC)
    outputs = engine.outputs_of(engine.state_of(events, SPEC), SPEC)
    times = events.groupBy(F.col("entity_id").alias("_id")).agg(F.max("at").alias("committed_at"))
    clock = F.lit("2024-03-01 00:00:00").cast("timestamp")
    sinks.upsert_batch(sink, SPEC, clock=clock)(outputs.join(times, "_id"), 0)
    return parity.lag_summary(parity.sink_lag(sinks.replica(spark, sink)))


def replica_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of a sink with a compacted base, an index, and batches after it."""
    sink = work_folder(spark, "page-sink")
    outputs = materialize(snapshot_outputs(spark, sf_dir), "snapshot")
    number = F.col("_id").cast("bigint")
    stale = outputs.withColumn("deleted", number % 5 == 0)
    for batch, rows in enumerate(
        (stale, outputs.filter(number % 5 == 0), outputs.filter(number % 97 == 0))
    ):
        sinks.upsert_batch(sink, SPEC)(rows, batch)
    sinks.compact(spark, sink, SPEC)
    doc = F.col("document")
    return sinks.page(spark, sink, "2").select(
        doc["id"].alias("id"),
        doc["updated_at"].alias("updated_at"),
        F.size(doc["addresses"]).alias("n_addresses"),
        F.size(doc["contacts"]).alias("n_contacts"),
    )


def workload_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.workload_profile(mapping.change_log(spark, sf_dir))


def transaction_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.transaction_sizes(routing.row_events(_decoded(spark, sf_dir)))


def write_rate_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = metrics.write_rate(routing.row_events(_decoded(spark, sf_dir)))
    return rates.select(F.unix_seconds("window_start").alias("window_start"), "writes")


def record_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.record_sizes(mapping.change_log(spark, sf_dir))


def write_rate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rate_summary(metrics.write_rate(routing.row_events(_decoded(spark, sf_dir))))


def hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = routing.row_events(_decoded(spark, sf_dir))
    return metrics.hot_keys(assembly.bundle_events(rows, SPEC), 20)


QUERIES = {
    "document_json": document_json,
    "dead_letters": dead_letters,
    "sink_latest": sink_latest,
    "final_documents_stream": final_documents_stream,
    "rebuilt_documents": rebuilt_documents,
    "change_feed": change_feed,
    "change_feed_stream": change_feed_stream,
    "latest_feed_event": latest_feed_event,
    "count_parity": count_parity,
    "field_parity": field_parity,
    "stale_mismatches": stale_mismatches,
    "sampled_parity": sampled_parity,
    "repair_list": repair_list,
    "replication_lag": replication_lag,
    "replica_page": replica_page,
    "workload_profile": workload_profile,
    "transaction_sizes": transaction_sizes,
    "write_rate_hourly": write_rate_hourly,
    "record_sizes": record_sizes,
    "write_rate_summary": write_rate_summary,
    "hot_keys": hot_keys,
}
