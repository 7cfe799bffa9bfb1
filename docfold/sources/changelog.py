"""Change-log sources: files or a message broker, as a batch or as a stream.

Bronze layout, one row per log record: ``source, key, value, seq, at``. ``key`` and ``value`` are
JSON text, ``seq`` is the total order of the log, ``at`` the event time. The bronze table is append
only: an END count needs every row, so it is never compacted by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.spec import MARKER_SOURCE, DocumentSpec

# A broker log is ordered by the position in the source's own log, in bytes.
BROKER_SLICE = 64 << 20

BRONZE = "source string, key string, value string, seq bigint, at timestamp"


def read_log(
    spark: SparkSession, path: str, streaming: bool = False, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A bronze log from files."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(BRONZE).format(fmt).options(**options).load(path)


def read_broker(
    spark: SparkSession, servers: str, topics: list[str], streaming: bool = True, **options: str
) -> DataFrame:
    """A bronze log from Kafka topics (needs the Kafka package on the cluster).

    The source is the last part of the topic name; ``seq`` is ``log_position``.
    """
    reader = spark.readStream if streaming else spark.read
    raw = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
    return raw.select(
        F.substring_index("topic", ".", -1).alias("source"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        log_position(F.col("value").cast("string")).alias("seq"),
        F.col("timestamp").alias("at"),
    )


def log_position(value: Column) -> Column:
    """The place of a record in the source's own log, which orders all tables and partitions alike.

    A row event names it in its source block, a transaction marker behind the colon of its id.
    Broker times and offsets are no such order: offsets count per partition, and times repeat. A
    record without a position has a null ``seq`` and is set aside as malformed.
    """
    own = F.get_json_object(value, "$.source.lsn")
    marker = F.substring_index(F.get_json_object(value, "$.id"), ":", -1)
    return F.coalesce(own.try_cast("bigint"), marker.try_cast("bigint"))


def include_tables(bronze: DataFrame, spec: DocumentSpec) -> DataFrame:
    """Only the model's tables and the transaction markers."""
    return bronze.filter(F.col("source").isin(*spec.tables, MARKER_SOURCE))


def snapshot_log(tables: dict[str, DataFrame], spec: DocumentSpec) -> DataFrame:
    """Every existing row of the base tables as a read event without a transaction.

    Rows of different tables share no state key, so ``seq`` may be the same for all of them.
    """
    parts = []
    for table in spec.tables:
        key = spec.root_key if table == spec.root else None
        child = next((c for c in spec.children if c.table == table), None)
        if child is not None:
            key = spec.row_key if child.is_collection else spec.owner_key
        frame = tables[table]
        event = F.struct(
            F.lit("r").alias("op"),
            F.lit(None).cast("string").alias("before"),
            F.struct(*[wire(frame, c) for c in frame.columns]).alias("after"),
        )
        parts.append(
            frame.select(
                F.lit(table).alias("source"),
                F.to_json(F.struct(F.col(key).alias(key))).alias("key"),
                F.to_json(event).alias("value"),
                F.lit(0).cast("bigint").alias("seq"),
                F.col("updated_at").cast("timestamp").alias("at"),
            )
        )
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log


def wire(frame: DataFrame, column: str, name: str | None = None) -> Column:
    """A column as the change log writes it: epoch days, epoch milliseconds, decimal text."""
    kind = dict(frame.dtypes)[column]
    value = F.col(name or column)
    if kind == "date":
        value = F.unix_date(value)
    elif kind in ("timestamp", "timestamp_ntz"):
        value = F.unix_millis(value.cast("timestamp"))
    elif kind.startswith("decimal"):
        value = value.cast("string")
    return value.alias(column)
