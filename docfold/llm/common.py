"""Helpers shared by the operators: tables, Arrow columns, components of a link graph."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docfold.session import materialize, prepare

#: Rows a Python task holds at once; texts can be long, so batches are small.
BATCH_ROWS = 512


def ready(spark: SparkSession) -> SparkSession:
    """The engine's session settings, and small Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, wish: str) -> str:
    """A column name like ``wish`` that the frame doesn't have."""
    while wish.lower() in {c.lower() for c in frame.columns}:
        wish += "_"
    return wish


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding it."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def map_batches(
    frame: DataFrame,
    step: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
    schema: T.StructType,
) -> DataFrame:
    """Run ``step`` over a task's Arrow batches; it yields columns by name."""
    fields = schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(fields)
        for columns in step(batches):
            arrays = [_array(columns[f.name], f.type) for f in target]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return frame.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def filter_batches(
    frame: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]
) -> DataFrame:
    """Keep the rows for which ``keep`` gives true, with all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), type=pa.bool_()))

    return frame.mapInArrow(run, frame.schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component) per linked node.

    The component is its smallest node. Alternating stars: the large star hangs a node's larger
    neighbours on its smallest one, the small star does so with the smaller ones, until nothing
    changes. Rounds grow with the logarithm of the longest chain. Each round is a written
    table, so a lost executor costs a round at most. Joins have one row per node on one side.
    """
    links = materialize(_directed(edges.select("a", "b").where("a <> b")).distinct(), "links")
    size = _signature(links)
    while size[0]:
        large = materialize(_star(links, larger=True), "links")
        links = materialize(_star(large, larger=False), "links")
        now = _signature(links)
        if now == size:
            break
        size = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(roots).distinct()


def _directed(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller node."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _signature(links: DataFrame) -> tuple:
    """Number of links, and a sum that changes with any of them."""
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def _star(links: DataFrame, larger: bool) -> DataFrame:
    both = links if not larger else links.union(links.select(F.col("b"), F.col("a")))
    both = both.toDF("u", "v")
    lowest = both.groupBy("u").agg(F.min("v").alias("m"))
    lowest = lowest.select("u", F.least("u", "m").alias("m"))
    hung = both.join(lowest, "u")
    if larger:
        hung = hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        own = lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))
        hung = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).union(own)
    return hung.where("a <> b").distinct()
