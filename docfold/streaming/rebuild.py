"""Rebuild: fold a log in batch, then let the stream go on from there.

``backfill`` takes the files a log has now as one batch: it stores the outputs as the sink's first batch and writes the
tables of the state, with the list of files they stand for. A stream started with that folder goes on from
these tables and leaves those files out, so every record counts once: in the tables or in
the stream. Transactions that are open at the cut are part of the state, with their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.operators import routing
from docfold.operators.skew import SLICE_ROWS
from docfold.session import materialize
from docfold.sources.changelog import BRONZE
from docfold.spec import DOCUMENT_LIMIT_BYTES, DocumentSpec
from docfold.streaming import state
from docfold.streaming.state import FIRST_BATCH


def read_files(
    spark: SparkSession, path: str, streaming: bool = False, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A bronze log from files, with the file each record is from (``file``)."""
    reader = spark.readStream if streaming else spark.read
    found = reader.schema(BRONZE).format(fmt).options(**options).load(path)
    return found.select("*", F.col("_metadata.file_path").alias("file"))


def remaining(log: DataFrame, folder: str) -> DataFrame:
    """The records of ``read_files`` that a backfill doesn't cover; works on a stream."""
    covered = log.sparkSession.read.parquet(f"{folder}/covered")
    return log.join(covered, "file", "left_anti").drop("file")


def backfill(
    log: DataFrame,
    spec: DocumentSpec,
    sink: str,
    folder: str,
    limit: int = DOCUMENT_LIMIT_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> None:
    """Fold ``log`` (from ``read_files``) into the sink, and write the state to ``folder``.

    ``covered`` is written last: it publishes the position the sink and the state are applied up to.
    ``limit`` has to be that of the stream.
    """
    # The frame's own listing decides: files that come later are the stream's.
    covered = materialize(log.select("file").distinct(), "backfill-files")
    decoded = routing.decode(log.drop("file"), spec)
    state.step(decoded, state.Tables(folder, spec), sink, FIRST_BATCH, limit, slice_rows)
    covered.write.parquet(f"{folder}/covered")
