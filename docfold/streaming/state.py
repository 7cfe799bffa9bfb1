"""The state of the streaming query, as tables, and the step that every micro-batch takes over them.

``waiting`` holds the records of open transactions, ``closed`` the transactions that were completed, and ``rows`` the newest
action per row of every entity, in buckets of entities. A micro-batch reads what the tables have on the transactions
and entities it touches, and writes one folder with its own part of each table, in overwrite mode, so a replay
changes nothing. Every ``MERGE_EVERY`` micro-batches the tables are written whole as a base, without what is needless by then. Which
folders count follows from the number of the micro-batch alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.operators import assembly, documents, fold, routing
from docfold.operators.skew import SLICE_ROWS, attach
from docfold.session import materialize, scratch
from docfold.sources.changelog import BRONZE
from docfold.spec import DOCUMENT_LIMIT_BYTES, DocumentSpec
from docfold.streaming import sinks

#: Fixed for the life of a query: after so many micro-batches the tables are written as a base.
MERGE_EVERY = 16
#: The batch of the sink and of the tables that holds what a backfill gave; the stream's batches start at 0.
FIRST_BATCH = -1

CLOSED = "txn_id string, batch bigint"
ROWS = (
    "entity_id string, source string, row_id string, seq bigint, action string, image string,"
    " removed_seq bigint, at timestamp, bucket int"
)


@dataclass(frozen=True)
class Tables:
    """The tables of one query in a folder all executors share, and those of the backfill it goes on from."""

    path: str
    spec: DocumentSpec
    seed: str | None = None

    def folder(self, batch_id: int, base: bool = False) -> str:
        return f"{self.path}/{'base' if base else 'batch'}/{batch_id}"

    def before(self, batch_id: int) -> list[str]:
        """The folders a micro-batch starts from: the newest base, and the batches after it."""
        first = max(0, batch_id // MERGE_EVERY * MERGE_EVERY)
        own = [self.folder(number) for number in range(first, batch_id)]
        if first:
            return [self.folder(first - 1, base=True), *own]
        return [Tables(self.seed, self.spec).folder(FIRST_BATCH), *own] if self.seed else own

    def schema(self, spark: SparkSession, table: str) -> T.StructType:
        if table != "waiting":
            return T.StructType.fromDDL(CLOSED if table == "closed" else ROWS)
        decoded = routing.decode(spark.createDataFrame([], BRONZE), self.spec).schema
        return T.StructType([*decoded, T.StructField("batch", T.LongType())])

    def read(self, spark: SparkSession, table: str, folders: list[str]) -> DataFrame:
        columns = self.schema(spark, table)
        found = [spark.read.schema(columns).parquet(f"{f}/{table}") for f in folders]
        return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], columns)

    def open_records(
        self, spark: SparkSession, folders: list[str], touched: DataFrame | None = None
    ) -> DataFrame:
        """Records whose transaction was not completed after they came; those of ``touched`` transactions, if given."""
        closed = self.read(spark, "closed", folders).groupBy("txn_id").agg(F.max("batch").alias("_closed"))
        waiting = self.read(spark, "waiting", folders)
        if touched is None:
            found = waiting.join(closed, "txn_id", "left")
        else:
            found = waiting.join(touched.join(closed, "txn_id", "left"), "txn_id")
        found = found.filter(F.col("_closed").isNull() | (F.col("_closed") < F.col("batch")))
        return found.select(*waiting.columns)

    def write_rows(self, rows: DataFrame, folder: str) -> None:
        bucketed = rows.withColumn("bucket", sinks.bucket_of(F.col("entity_id")))
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/rows")

    def merge(self, spark: SparkSession, batch_id: int) -> None:
        """Write the tables after a micro-batch as a base, and remove what the base before replaces.

        That base and the batches after it stay, because this micro-batch may be replayed.
        """
        folders, target = [*self.before(batch_id), self.folder(batch_id)], self.folder(batch_id, base=True)
        with scratch(spark):
            newest = materialize(newest_rows(self.read(spark, "rows", folders)), "newest")
            is_root = F.col("source") == self.spec.root
            dead = newest.filter(is_root).select("entity_id", F.col("removed_seq").alias("_dead"))
            kept = newest.join(dead, "entity_id", "left").filter(
                is_root | F.col("_dead").isNull() | (F.col("seq") > F.col("_dead"))
            )
            self.write_rows(kept.select(*newest.columns), target)
            self.open_records(spark, folders).write.mode("overwrite").parquet(f"{target}/waiting")
            none = spark.createDataFrame([], CLOSED)
            none.write.mode("overwrite").parquet(f"{target}/closed")
        last = batch_id - MERGE_EVERY
        old = [self.folder(last - MERGE_EVERY, base=True)]
        sinks.remove(spark, old + [self.folder(number) for number in range(last - MERGE_EVERY + 1, last + 1)])


def newest_rows(rows: DataFrame) -> DataFrame:
    """The newest action per row with its newest removal, and the newest time; columns as in ``ROWS``."""
    newest = F.max_by(F.struct("seq", "action", "image"), "seq").alias("w")
    more = [F.max(c).alias(c) for c in rows.columns if c in ("removed_seq", "removed_before", "at")]
    keys = ["entity_id", "source", "row_id"]
    found = rows.groupBy(*keys).agg(newest, *more)
    return found.select(*keys, "w.seq", "w.action", "w.image", *found.columns[4:])


def step(
    decoded: DataFrame,
    tables: Tables,
    sink: str,
    batch_id: int,
    limit: int = DOCUMENT_LIMIT_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> None:
    """Take the decoded records of one micro-batch: hold or release them, fold them, and write the sink's batch."""
    spark, spec = decoded.sparkSession, tables.spec
    folders, target = tables.before(batch_id), tables.folder(batch_id)
    with scratch(spark):
        new = materialize(decoded, "decoded")
        records = new
        if folders:
            touched = new.filter("txn_id is not null and not malformed").select("txn_id").distinct()
            earlier = materialize(tables.open_records(spark, folders, touched).drop("batch"), "earlier")
            records = earlier.unionByName(new)
        rows, markers = routing.row_events(records), routing.marker_events(records)
        transactions = materialize(assembly.progress(rows, markers), "progress")
        number = F.lit(batch_id).cast("bigint").alias("batch")
        complete = F.col("status") == "complete"
        transactions.filter(complete).select("txn_id", number).write.mode("overwrite").parquet(f"{target}/closed")
        still = transactions.filter(~complete).select("txn_id", "seen")
        held = new.filter("txn_id is not null and not malformed")
        held = attach(held, still, "txn_id", "seen", ["seq"], slice_rows).select(*new.columns, number)
        held.write.mode("overwrite").parquet(f"{target}/waiting")

        events = assembly.bundle_events(assembly.committed(rows, transactions, slice_rows), spec)
        removed = F.when(F.col("action") == "remove", F.col("seq")).alias("removed_seq")
        acts = events.filter("action <> 'none'").select(
            "entity_id", "source", "row_id", "seq", "action", "image", "at", removed
        )
        tables.write_rows(newest_rows(acts), target)
        _fold(spark, tables, sink, batch_id, limit)
    if batch_id % MERGE_EVERY == MERGE_EVERY - 1:
        tables.merge(spark, batch_id)


def _fold(spark: SparkSession, tables: Tables, sink: str, batch_id: int, limit: int) -> None:
    """One output per entity that the micro-batch touched: its document, its error, or its delete marker."""
    spec, folders = tables.spec, tables.before(batch_id)
    never = F.lit(None).cast("bigint")
    own = tables.read(spark, "rows", [tables.folder(batch_id)]).withColumn("removed_before", never)
    latest = own
    if folders:
        buckets = [r["bucket"] for r in own.select("bucket").distinct().collect()]
        known = tables.read(spark, "rows", folders).filter(F.col("bucket").isin(*buckets))
        known = known.join(own.select("entity_id").distinct(), "entity_id", "left_semi").withColumns(
            {"removed_before": F.col("removed_seq"), "at": F.lit(None).cast("timestamp")}
        )
        latest = materialize(newest_rows(known.unionByName(own)), "latest")
    else:
        latest = latest.drop("bucket")
    entities = materialize(fold.lifetimes(latest, spec), "entities")
    removed_before = F.when(F.col("source") == spec.root, F.col("removed_before"))
    touched = latest.groupBy(F.col("entity_id").alias("_id")).agg(
        F.max("seq").alias("version"),
        F.max("at").alias("committed_at"),
        F.coalesce(F.max(removed_before), F.lit(-1)).alias("_died"),
    )
    live = fold.live_rows(latest.drop("at", "removed_before"), entities, limit)
    docs = documents.documents(*live, spec, limit)
    outputs = documents.with_markers(docs, fold.delete_markers(entities)).join(touched, "_id")
    # An entity whose root was gone before gives no second marker.
    gone = entities.select(F.col("entity_id").alias("_id"), "dead_before")
    outputs = outputs.join(gone, "_id").filter(~F.col("deleted") | (F.col("dead_before") > F.col("_died")))
    sinks.upsert_batch(sink, spec, limit)(outputs.drop("_died", "dead_before"), batch_id)
