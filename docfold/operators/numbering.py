"""Consecutive numbers over a whole frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docfold.session import materialize


def dense_number(frame: DataFrame, order: list[Column], name: str, start: int = 0) -> DataFrame:
    """Add consecutive numbers from ``start`` in the given order, without one global sort task.

    Rows are range-partitioned and numbered inside their partition; the offsets come from one row
    per partition, so the broadcast is bounded by the number of partitions.
    """
    ranged = materialize(
        frame.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranged"
    )
    placed = ranged.withColumn("_i", F.row_number().over(W.partitionBy("_p").orderBy(*order)))
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return (
        placed.join(F.broadcast(offsets), "_p")
        .withColumn(name, F.col("_o") + F.col("_i") - 1 + start)
        .drop("_p", "_i", "_o")
    )
