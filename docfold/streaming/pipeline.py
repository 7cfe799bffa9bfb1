"""The streaming query: change log in, documents, delete markers and dead letters out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docfold.operators import routing
from docfold.operators.skew import SLICE_ROWS
from docfold.session import STATE_PROVIDER
from docfold.spec import DOCUMENT_LIMIT_BYTES, DocumentSpec
from docfold.streaming import state


def configure(spark: SparkSession) -> None:
    """Keyed stages need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)


def start(
    bronze: DataFrame,
    spec: DocumentSpec,
    sink: str,
    checkpoint: str,
    limit: int = DOCUMENT_LIMIT_BYTES,
    available_now: bool = False,
    interval: str = "1 second",
    slice_rows: int = SLICE_ROWS,
    seed: str | None = None,
):
    """Start the query; ``sink`` and ``checkpoint`` are folders all executors share.

    The state is kept as tables below the checkpoint. ``seed`` is the folder a ``rebuild.backfill`` has written, for a
    query that goes on from it; give ``rebuild.remaining`` of the log then, and the same folder at each start from this
    checkpoint. Rows of a transaction above ``slice_rows`` are spread.
    """
    tables = state.Tables(f"{checkpoint}/tables", spec, seed)

    def take(decoded: DataFrame, batch_id: int) -> None:
        state.step(decoded, tables, sink, batch_id, limit, slice_rows)

    writer = (
        routing.decode(bronze, spec)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(take)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def start_malformed(
    bronze: DataFrame,
    spec: DocumentSpec,
    sink: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "1 second",
):
    """Start a query that sets aside input records that are no JSON object, with their position."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        routing.malformed(routing.decode(bronze, spec))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(sink)
    )
