"""Change feeds of source and replica as streams, and both as one feed in the order of event time.

The replica's changes are read from the log of the sink. What kind a change is depends on whether its id was there
before, which is state per id. A replayed batch comes again under the same batch id and is passed over.

The joint feed is put in order by micro-batches: each feed's newest event time, less a delay, is how far that feed has
come, and the feed that is behind decides for both. Events before this frontier are released in order, the others
wait. An event that arrives behind the frontier, or has no time, is listed as late. Every table has one folder per
micro-batch, written in overwrite mode and made from the folders of the one before, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.operators import feed, routing
from docfold.spec import CUSTOMER_SPEC, DocumentSpec
from docfold.streaming import pipeline, sinks, stages
from docfold.streaming.stages import StoredChange

# The stage travels with the query, so the workers need no installed package.
cloudpickle.register_pickle_by_value(stages)

FEEDS = ("source", "replica")
EVENT = "feed string, operation string, id string, customer_number string, at timestamp"
ORDER = ["at", "feed", "id", "operation"]
PROGRESS = "feed string, newest timestamp"


def replica_stream(
    spark: SparkSession, sink: str, spec: DocumentSpec = CUSTOMER_SPEC
) -> DataFrame:
    """Changes of the replica, from the log of the sink: ``StoredChange.OUTPUT``.

    The files of an id come in the order of the sink's batches. Read them before ``sinks.expire`` removes them.
    """
    pipeline.configure(spark)
    wanted = ["_id", "deleted", "version", "committed_at", "outcome", "batch_id", "bucket"]
    columns = T.StructType([f for f in sinks.schema(spark, spec) if f.name in wanted])
    log = spark.readStream.schema(columns).option("ignoreMissingFiles", "true").parquet(f"{sink}/log")
    stored = log.filter("outcome = 'stored'").select(
        "_id", "deleted", F.coalesce("version", F.lit(-1)).alias("version"), "committed_at", "batch_id"
    )
    return stored.groupBy("_id").transformWithState(StoredChange(), StoredChange.OUTPUT, "Append", "None")


def joint_stream(bronze: DataFrame, sink: str, spec: DocumentSpec) -> DataFrame:
    """The feeds of a streamed log and of the sink as one stream, unordered."""
    rows = routing.row_events(routing.decode(bronze, spec))
    replica = replica_stream(bronze.sparkSession, sink, spec)
    return feed.combined(feed.notifications(rows, spec), replica.select("id", "operation", "at"))


def start(
    bronze: DataFrame,
    spec: DocumentSpec,
    sink: str,
    path: str,
    checkpoint: str,
    delay_seconds: int = 60,
    available_now: bool = False,
    interval: str = "1 second",
):
    """Start the joint feed of a streamed log and of a sink; it goes to the folder ``path`` in order.

    ``path`` belongs to this checkpoint: its folders are named by the query's micro-batches.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        joint_stream(bronze, sink, spec)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(order_batch(path, delay_seconds))
        .trigger(**trigger)
        .start()
    )


def _folder(path: str, table: str, batch_id: int) -> str:
    return f"{path}/{table}/batch_id={batch_id}"


def _part(spark: SparkSession, path: str, table: str, batch_id: int) -> DataFrame:
    return sinks.read_folder(spark, _folder(path, table, batch_id), T.StructType.fromDDL(EVENT))


def _progress(spark: SparkSession, path: str, batch_id: int) -> dict:
    """How far each feed had come after a micro-batch."""
    schema = T.StructType.fromDDL(PROGRESS)
    rows = sinks.read_folder(spark, _folder(path, "progress", batch_id), schema).collect()
    return {r["feed"]: r["newest"] for r in rows}


def _frontier(progress: dict) -> object:
    """The newest time both feeds have reached; null until both have had an event."""
    return min(progress.values()) if set(progress) >= set(FEEDS) else None


def order_batch(path: str, delay_seconds: int) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for events shaped like ``EVENT``."""

    def write(events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        delay = F.expr(f"interval {int(delay_seconds)} seconds")

        def save(frame: DataFrame, table: str) -> None:
            frame.write.mode("overwrite").parquet(_folder(path, table, batch_id))

        save(events, "arrived")
        arrived = _part(spark, path, "arrived", batch_id)
        progress = _progress(spark, path, batch_id - 1)
        before = _frontier(progress)
        for r in arrived.groupBy("feed").agg(F.max("at").alias("newest")).collect():
            if r["newest"] is not None:
                progress[r["feed"]] = max(r["newest"], progress.get(r["feed"], r["newest"]))
        after = _frontier(progress)

        def behind(frontier) -> Column:
            return F.lit(False) if frontier is None else F.col("at") < F.lit(frontier) - delay

        late = F.col("at").isNull() | behind(before)
        save(arrived.filter(late), "late")
        open_ = _part(spark, path, "waiting", batch_id - 1).unionByName(arrived.filter(~late))
        save(open_.filter(behind(after)).orderBy(*ORDER), "ordered")
        save(open_.filter(~behind(after)), "waiting")
        save(spark.createDataFrame(list(progress.items()), PROGRESS).coalesce(1), "progress")
        # A replay of this batch needs the one before, and no earlier one.
        sinks.remove(spark, [_folder(path, t, batch_id - 2) for t in ("arrived", "waiting", "progress")])

    return write


def _table(spark: SparkSession, path: str, table: str) -> DataFrame:
    columns = T.StructType.fromDDL(EVENT + ", batch_id bigint")
    return sinks.read_folder(spark, f"{path}/{table}", columns)


def ordered(spark: SparkSession, path: str) -> DataFrame:
    """The released events with their micro-batch. Their order is ``ORDER``; later batches only add to the end."""
    return _table(spark, path, "ordered")


def late(spark: SparkSession, path: str) -> DataFrame:
    """Events that came after their place in the feed was released, or have no time."""
    return _table(spark, path, "late")


def waiting(spark: SparkSession, path: str) -> DataFrame:
    """Events that the frontier has not passed yet."""
    columns = T.StructType.fromDDL(PROGRESS + ", batch_id bigint")
    done = sinks.read_folder(spark, f"{path}/progress", columns)
    newest = done.agg(F.max("batch_id")).first()[0]
    return _part(spark, path, "waiting", -1 if newest is None else newest)
