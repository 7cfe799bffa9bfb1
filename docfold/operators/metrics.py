"""Workload measurements of a change log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docfold.session import materialize


def workload_profile(bronze: DataFrame) -> DataFrame:
    """One row per source: records, and bytes per record."""
    size = F.octet_length("value") + F.coalesce(F.octet_length("key"), F.lit(0))
    records = (
        bronze.filter("value is not null")
        .withColumn("size", size)
        .groupBy("source")
        .agg(
            F.count("*").alias("records"),
            F.sum("size").cast("bigint").alias("total_bytes"),
            F.max("size").cast("bigint").alias("largest"),
        )
    )
    return records.withColumn("average_bytes", F.floor(F.col("total_bytes") / F.col("records")))


def ranked_summary(values: DataFrame, column: str, quantiles: dict[str, float]) -> DataFrame:
    """One row: ``n``, ``total``, the named quantiles and ``largest`` of a whole-number column.

    A quantile is the smallest value whose share of all values up to it reaches it, whatever the
    number of values: values are counted first, and ranks are running sums over the distinct ones.
    """
    counts = values.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_c"))
    # Distinct values are ranged over tasks and summed inside each; the sums before a range come from one
    # row per range, so those windows are bounded by the number of partitions.
    ranged = counts.repartitionByRange(column).withColumn("_p", F.spark_partition_id())
    ranged = materialize(ranged, "ranks")
    sums = ranged.groupBy("_p").agg(F.sum("_c").alias("_s"))
    earlier = F.sum("_s").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select("_p", F.coalesce(earlier, F.lit(0)).alias("_o"), F.sum("_s").over(W.partitionBy()).alias("_n"))
    inside = F.sum("_c").over(W.partitionBy("_p").orderBy(column).rowsBetween(W.unboundedPreceding, 0))
    placed = ranged.withColumn("_i", inside).join(F.broadcast(offsets), "_p")
    ranks = placed.withColumn("_r", F.col("_o") + F.col("_i"))
    return ranks.agg(
        F.coalesce(F.max("_n"), F.lit(0)).alias("n"),
        F.sum(F.col(column) * F.col("_c")).alias("total"),
        *[
            F.min(F.when(F.col("_r") >= F.col("_n") * q, F.col(column))).alias(name)
            for name, q in quantiles.items()
        ],
        F.max(column).alias("largest"),
    )


def transaction_sizes(rows: DataFrame) -> DataFrame:
    """One row: transactions, rows, and median, 95th and 99th percentile of rows per transaction."""
    sizes = rows.filter("txn_id is not null").groupBy("txn_id").agg(F.count("*").alias("size"))
    quantiles = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return ranked_summary(sizes, "size", quantiles).select(
        F.col("n").alias("transactions"), F.col("total").alias("rows"), *quantiles, "largest"
    )


def record_sizes(bronze: DataFrame) -> DataFrame:
    """One row: records, bytes, and median, 95th and 99th percentile of bytes per record."""
    size = F.octet_length("value") + F.coalesce(F.octet_length("key"), F.lit(0))
    sizes = bronze.filter("value is not null").select(size.cast("bigint").alias("size"))
    quantiles = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return ranked_summary(sizes, "size", quantiles).select(
        F.col("n").alias("records"), F.col("total").alias("total_bytes"), *quantiles, "largest"
    )


def rate_summary(rates: DataFrame) -> DataFrame:
    """One row from hourly ``write_rate``: hours from first to last, writes, sustained and peak rate."""
    first, last = F.min("window_start"), F.max("window_start")
    spanned = (F.unix_seconds(last) - F.unix_seconds(first)) / 3600 + 1
    return rates.agg(
        spanned.cast("bigint").alias("hours"),
        F.sum("writes").alias("writes"),
        F.max("writes").alias("peak"),
    ).withColumn("sustained", F.floor(F.col("writes") / F.col("hours")))


def write_rate(rows: DataFrame, width: str = "1 hour") -> DataFrame:
    """Row events per tumbling window of event time: sustained against peak."""
    return (
        rows.groupBy(F.window("at", width).alias("w"))
        .agg(F.count("*").alias("writes"))
        .select(F.col("w.start").alias("window_start"), "writes")
    )


def hot_keys(events: DataFrame, top: int) -> DataFrame:
    """The entities with the most events (a top-k report), ties by id."""
    return (
        events.groupBy("entity_id")
        .agg(F.count("*").alias("n_events"))
        .orderBy(F.col("n_events").desc(), "entity_id")
        .limit(top)
    )
